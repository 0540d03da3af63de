"""The operators' registered queries, ``name -> (spark, sf_dir) -> DataFrame``, each over its
whole table, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tillcast.llm import (
    best_fit,
    chat_tree,
    grid_join,
    kernel_langid,
    license_scan,
    ngram_jaccard,
    periodic_runs,
    pii,
    piece_viterbi,
    pruned_graph,
    spelling,
    token_parquet,
    url_filter,
)
from tillcast.llm.common import read_table
from tillcast.session import checkpoint_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Folder of the public tokenizer files (see its README).
TOKENIZERS = "/opt/tokenizers"
PLANTED_CONVERSATION, PLANTED_TEXT = -7, "\\### Assistant: </turn> ok"
# The rules of op11.
URL_RULES = ("block net/", "allow example.net/en/", "block example.com/de/", "allow org/fr/")


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _folder(spark: SparkSession, tag: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/tillcast-{tag}-{uuid.uuid4().hex}"


def tokenizer(name: str) -> str:
    return os.path.join(TOKENIZERS, name)


@query
def op1_ngram_jaccard(spark, sf):
    return ngram_jaccard.link_components(read_table(spark, sf, "documents"), k=4, num=85, den=100)


@query
def op2_grid_order_join(spark, sf):
    return grid_join.near_duplicates(read_table(spark, sf, "embeddings"), cosine=0.9)


@query
def op3_license_scan(spark, sf):
    return license_scan.scan(read_table(spark, sf, "documents"))


@query
def op4_kernel_langid(spark, sf):
    docs = read_table(spark, sf, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    model = kernel_langid.fit(docs, usable=~held_out & F.col("doc_id").isNotNull())
    return (kernel_langid.predict(docs, model)
            .select("doc_id", held_out.alias("held_out"), "lang_pred", "score"))


@query
def op5_pruned_graph(spark, sf):
    rows = read_table(spark, sf, "embeddings")
    index, dim = pruned_graph.build_index(rows)
    return pruned_graph.search(index, dim, rows.filter(F.col("vec_id") % 20 == 0), k=20)


@query
def op6_piece_viterbi(spark, sf):
    return piece_viterbi.encode(read_table(spark, sf, "documents"), tokenizer("piece_bpe_32k.model"))


@query
def op7_personal_data(spark, sf):
    return pii.detect(read_table(spark, sf, "documents"))


@query
def op8_best_fit(spark, sf):
    return best_fit.best_fit(read_table(spark, sf, "documents"))


@query
def op9_token_parquet(spark, sf):
    folder = _folder(spark, "tokens")
    token_parquet.write_tokens(read_table(spark, sf, "documents"), folder, tokenizer("word_bpe_49k.json"))
    return token_parquet.token_digests(spark, folder)


@query
def op10_chat_tree(spark, sf):
    rows = read_table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    planted = [Row(PLANTED_CONVERSATION, i, role, PLANTED_TEXT) for i, role in enumerate(("user", "assistant"))]
    rows = rows.unionByName(spark.createDataFrame(planted, "conv_id long, turn long, role string, text string"))
    folder = _folder(spark, "chat")
    chat_tree.write_chat(rows, folder)
    return chat_tree.read_digests(spark, folder)


@query
def op11_url_filter(spark, sf):
    return url_filter.judge(read_table(spark, sf, "pages"), URL_RULES)


@query
def op12_spelling_variants(spark, sf):
    return spelling.variants(read_table(spark, sf, "documents"))


@query
def op13_periodic_runs(spark, sf):
    return periodic_runs.report(read_table(spark, sf, "documents"))


# Words of a text as SQL: blanks and control white space folded to one blank.
_WORDS = r"""list_filter(string_split(regexp_replace(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+', ' ', 'g'), ' '), lambda x: x <> '')"""

#: Components: labels spread along links until none changes (the recursion ends when no
#: smaller label is found).
_COMPONENTS = """
reach(node, other) AS (
    SELECT a, b FROM links
    UNION
    SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other)
"""



def _url_rules(what: int) -> str:
    """A CASE that gives the longest rule that fits (``what`` 1) or its verdict (0)."""
    out = "CASE "
    for rule in sorted(URL_RULES, key=lambda r: -len(r.split(" ")[1])):
        own, rest = rule.split(" ")[1].split("/", 1)
        out += (f"WHEN (host = '{own}' OR ends_with(host, '.{own}')) AND starts_with(path, '/{rest}') "
                f"THEN '{rule.split(' ')[what]}' ")
    return out + "END"


def _url_levels(order: int) -> str:
    """The models level by level: shares of accepted (pa) and rejected (pr), value and gain."""
    def share(n, total, kinds, lower):
        return f"CASE WHEN {total} = 0 THEN {lower} ELSE ({n} + {kinds} * {lower}) / ({total} + {kinds}) END"
    out = []
    for k in range(order + 1):
        even = "(SELECT 1.0::DOUBLE / (count(*) + 1) FROM counts WHERE length(s) = 1)"
        lower = f"{even} AS la, {even} AS lr, 0 AS ld, " if k == 0 else "b.pa AS la, b.pr AS lr, b.value AS ld, "
        below = "" if k == 0 else f"JOIN level{k - 1} b ON b.s = substr(c.s, 2)"
        out.append(f"""level{k} AS MATERIALIZED (
    SELECT s, pa, pr, CAST(floor((ln(pa) - ln(pr)) * 1e6::DOUBLE + 0.5::DOUBLE) AS BIGINT) AS value, value - ld AS gain FROM (
        SELECT s, ld, {share('na', 'ca', 'ta', 'la')} AS pa, {share('nr', 'cr', 'tr', 'lr')} AS pr FROM (
            SELECT c.s, {lower} na, nr, ca, ta, cr, tr FROM counts c JOIN after_ a ON a.context = left(c.s, length(c.s) - 1)
            {below} WHERE length(c.s) = {k + 1})))""")
    return ",\n".join(out)


def _url_strings(source: str, columns: str) -> str:
    return f"""(SELECT {columns}, unnest(list_transform(range(0, least({url_filter.ORDER}, p - 1) + 1), lambda k:
        substr(t, p - k, CAST(k + 1 AS INTEGER)))) AS s FROM (SELECT {columns}, t, unnest(range(2, length(t) + 1)) AS p
        FROM (SELECT {columns}, chr(2) || text || chr(3) AS t FROM {source})))"""


_HELD = "substr(md5(text), 1, 1) IN (" + ", ".join(f"'{c}'" for c in url_filter.HELD_OUT) + ")"
_URL_FILTER = f"""
WITH parts AS (
    SELECT row_number() OVER () AS row, page_id,
           coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                              'abcdefghijklmnopqrstuvwxyz'), '') AS host,
           coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path FROM pages),
ruled AS (
    SELECT *, {_url_rules(1)} AS rule, {_url_rules(0)} AS ruling,
           regexp_matches(host, '(^|[.-])({'|'.join(url_filter.SEED_TERMS)})([.-]|$)') AS unwanted,
           regexp_replace(host || translate(path, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[0-9]+', '0', 'g') AS text FROM parts),
judged AS MATERIALIZED (
    SELECT *, {_HELD} AS held,
           CASE WHEN ruling = 'allow' THEN CASE WHEN NOT unwanted THEN false END
                ELSE ruling IS NOT NULL OR unwanted END AS rejected FROM ruled),
learnt AS (SELECT text, CAST(NOT rejected AS BIGINT) AS accepted, CAST(rejected AS BIGINT) AS rejects FROM judged
           WHERE rejected IS NOT NULL AND NOT held),
counts AS MATERIALIZED (
    SELECT s, sum(accepted) AS na, sum(rejects) AS nr FROM {_url_strings('learnt', 'accepted, rejects')}
    GROUP BY s HAVING length(s) = 1 OR sum(accepted) + sum(rejects) >= {url_filter.MIN_COUNT}),
after_ AS MATERIALIZED (
    SELECT left(s, length(s) - 1) AS context, sum(na) AS ca, count(*) FILTER (na > 0) AS ta, sum(nr) AS cr,
           count(*) FILTER (nr > 0) AS tr FROM counts GROUP BY 1),
{_url_levels(url_filter.ORDER)},
model AS ({' UNION ALL '.join(f'SELECT s, gain FROM level{k}' for k in range(url_filter.ORDER + 1))}),
totals AS (SELECT row, sum(coalesce(gain, 0)) AS total FROM {_url_strings('judged', 'row')} LEFT JOIN model USING (s)
           GROUP BY row),
scored AS (
    SELECT j.*, CAST(total AS DOUBLE) / (length(text) + 1) AS mean,
           greatest(least(floor(mean / 1000), {url_filter.SCORE_BOUND}), -{url_filter.SCORE_BOUND}) AS bin
    FROM judged j JOIN totals USING (row)),
bins AS (SELECT bin, count(*) AS c FROM scored WHERE held AND NOT rejected GROUP BY bin),
border AS (
    SELECT max(bin) AS least_ FROM (
        SELECT bin, coalesce(sum(c) OVER (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
               sum(c) OVER () AS total FROM bins) WHERE below * 1000 <= total * {url_filter.FALSE_REJECTS})
SELECT page_id, host, path, rule,
       coalesce(ruling, CASE WHEN (SELECT max(nr) FROM counts) > 0 AND bin < (SELECT least_ FROM border) THEN 'block'
                             ELSE 'allow' END) AS verdict,
       CASE WHEN rule IS NULL THEN mean / 1e6::DOUBLE END AS score
FROM scored"""

# CRC-32 of a string: each byte, then eight times one bit of it (marked -1).
_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, 9 * (length(hex(encode(k))) // 2)),
    lambda i: CASE WHEN i % 9 = 0 THEN CAST('0x' || substr(hex(encode(k)), 2 * (i // 9) + 1, 2) AS BIGINT) ELSE -1 END)),
    lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) ELSE xor(c >> 1, (c & 1) * 3988292384::BIGINT) END),
    4294967295::BIGINT)"""
_LATIN = "".join(map(chr, range(0xC0, 0x100)))
_SINGLE = "".join(c for c in map(chr, range(0x21, 0x7F)) if not c.islower())[:64].replace("'", "''")
_SPELLING = f"""
WITH RECURSIVE runs AS (SELECT run, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS k, count(*) AS c FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
    WHERE length(run) >= {spelling.MIN_LENGTH} GROUP BY ALL),
hashed AS (SELECT run, c, {_CRC32} AS h FROM runs),
words AS MATERIALIZED (
    SELECT word, sum(c) AS n FROM (
        SELECT c, CASE WHEN h % {spelling.SPOIL} = 0
            THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed)
    WHERE length(word) >= {spelling.MIN_LENGTH} GROUP BY word HAVING sum(c) >= {spelling.MIN_COUNT}),
single AS (SELECT word, n, length(word) AS m, translate(word, '{_LATIN}', '{_SINGLE}') AS w FROM words),
near AS MATERIALIZED (
    SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM single a JOIN single b
    ON abs(a.m - b.m) <= 1 AND a.word <> b.word AND levenshtein(a.w, b.w) = 1),
best AS (SELECT word, count(*) AS n_near, max(other_n) AS top, min(other) FILTER (WHERE other_n = top_n) AS other
         FROM (SELECT *, max(other_n) OVER (PARTITION BY word) AS top_n FROM near) GROUP BY word),
forms AS MATERIALIZED (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 2 * w.n THEN other END AS form,
           CASE WHEN top >= 2 * w.n THEN top END AS form_n FROM words w LEFT JOIN best USING (word)),
follow(word, root, form) AS (
    SELECT word, word, form FROM forms
    UNION ALL SELECT f.word, f.form, g.form FROM follow f JOIN forms g ON g.word = f.form)
SELECT f.word, f.form, r.root, CAST(f.n AS BIGINT) AS n, CAST(f.n_near AS BIGINT) AS n_near, CAST(f.form_n AS BIGINT) AS form_n
FROM forms f JOIN follow r ON r.word = f.word AND r.form IS NULL"""

ORACLE: dict[str, str] = {
    "op11_url_filter": _URL_FILTER,
    "op12_spelling_variants": _SPELLING,
    "op1_ngram_jaccard": f"""
WITH RECURSIVE words AS (SELECT doc_id, {_WORDS} AS w FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b
           ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
          WHERE 100 * c >= 85 * (x.n + y.n - c)),
{_COMPONENTS}
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles,
       least(d.doc_id, coalesce((SELECT min(other) FROM reach r WHERE r.node = d.doc_id), d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes s USING (doc_id)""",
    "op2_grid_order_join": f"""
WITH RECURSIVE v AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
          AND list_cosine_similarity(a.e, b.e) >= 0.9),
n AS (SELECT a AS vec_id, count(*) AS c FROM links GROUP BY a),
{_COMPONENTS},
comp AS (SELECT node AS vec_id, min(other) AS m FROM reach GROUP BY node)
SELECT e.vec_id, coalesce(n.c, 0) AS n_links, least(e.vec_id, coalesce(comp.m, e.vec_id)) AS component_id,
       least(e.vec_id, coalesce(comp.m, e.vec_id)) = e.vec_id AS kept
FROM embeddings e LEFT JOIN n USING (vec_id) LEFT JOIN comp USING (vec_id)""",
    "op10_chat_tree": r"""
WITH c AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
w AS (
    SELECT *, replace(replace(replace(text, '\', '\\'), '#', '\#'), '</turn', '<\/turn') AS body,
           replace(replace(replace(replace(role, '\', '\\'), '#', '\#'), '</turn', '<\/turn'), ':', '\:') AS head FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(4 + length(head) + 2 + length(body) + 8)::BIGINT AS formatted_chars
FROM w GROUP BY conv_id""",
}
