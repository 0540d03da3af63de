"""URL filter, spelling variants and periodic runs against brute force and odd inputs."""

import hashlib
import math
import os
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillcast.llm import periodic_runs, queries, spelling, url_filter
from tillcast.llm.queries import URL_RULES

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")
# Further columns have the operators' own names.
PAGES = "url string, page_id long, host string, path string, text string, s string, rule string, n int"
DOCS = "text string, doc_id long, word string, n int, start int, form string, key string"


# --- URL filter ---------------------------------------------------------------------------

def pages(spark, urls, ids=None):
    return spark.createDataFrame([(u, i if ids is None else ids[i], "h", "p", "t", "s", "r", 1)
                                  for i, u in enumerate(urls)], PAGES)


def brute_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    host, rest = rest[:cut], rest[cut:]
    cut = next((i for i, c in enumerate(rest) if c in "?#"), len(rest))
    return re.sub("[A-Z]", lambda m: m.group().lower(), host), rest[:cut]


def brute_rule(host, path):
    best = None
    for rule in URL_RULES:
        verdict, where = rule.split(" ")
        own, rest = where.split("/", 1)
        if (host == own or host.endswith("." + own)) and path.startswith("/" + rest):
            if best is None or len(where) > len(best[1]):
                best = verdict, where
    return best


def brute_judge(urls, order=url_filter.ORDER, least=url_filter.MIN_COUNT):
    """Verdicts by the definition: the longest kept string decides at each place."""
    rows = []
    for url in urls:
        host, path = brute_parts(url)
        rule = brute_rule(host, path)
        unwanted = any(t in url_filter.SEED_TERMS for t in re.split(r"[.-]", host))
        text = re.sub("[0-9]+", "0", host + re.sub("[A-Z]", lambda m: m.group().lower(), path))
        label = (None if unwanted else 0) if rule and rule[0] == "allow" else int(bool(rule) or unwanted)
        rows.append((host, path, rule, text, label, hashlib.md5(text.encode()).hexdigest()[0] in url_filter.HELD_OUT))

    def places(text):
        t = "\u0002" + text + "\u0003"
        return [[t[p - k:p + 1] for k in range(min(order, p) + 1)] for p in range(1, len(t))]

    counts = defaultdict(lambda: [0, 0])
    for *_, text, label, held in rows:
        if label is not None and not held:
            for strings in places(text):
                for s in strings:
                    counts[s][label] += 1
    counts = {s: c for s, c in counts.items() if len(s) == 1 or sum(c) >= least}
    after = defaultdict(lambda: ([0, 0], [0, 0]))
    for s, c in counts.items():
        for x in (0, 1):
            after[s[:-1]][0][x] += c[x]
            after[s[:-1]][1][x] += c[x] > 0
    even = 1.0 / (sum(len(s) == 1 for s in counts) + 1)

    def share(s, x):
        lower = share(s[1:], x) if len(s) > 1 else even
        total, kinds = after[s[:-1]][0][x], after[s[:-1]][1][x]
        return (counts[s][x] + kinds * lower) / (total + kinds) if total else lower

    def mean(text):
        total = 0
        for strings in places(text):
            known = [s for s in strings if s in counts]
            if known:
                s = known[-1]
                total += math.floor((math.log(share(s, 0)) - math.log(share(s, 1))) * 1e6 + 0.5)
        return total / len(places(text))

    bins = sorted(max(-url_filter.SCORE_BOUND, min(url_filter.SCORE_BOUND, math.floor(mean(t) / 1000)))
                  for *_, t, label, held in rows if held and label == 0)
    border = max((b for b in bins if sum(x < b for x in bins) * 1000 <= len(bins) * url_filter.FALSE_REJECTS),
                 default=None)
    learnt = any(c[1] for c in counts.values())
    out = []
    for host, path, rule, text, *_ in rows:
        bad = learnt and border is not None and math.floor(mean(text) / 1000) < border
        out.append((host, path, rule and rule[1], rule[0] if rule else "block" if bad else "allow"))
    return out


ODD_URLS = [None, "", "no scheme", "://", "http://", "HTTP://Example.NET/en/a?q#f", "https://a.example.net/EN/", "x://net",
            "x://net/", "x://org/fr/1", "x://notnet/", "ftp://a?b/c", "a://b://c/d", "http://Ünï.org/fr/ü\n1",
            "http://" + "x" * 5000 + ".com/" + "y" * 40_000, "https://www.cheap-pills.example.com/fr/1",
            "https://www.cheap-pills.example.com/fr/1", "\U0001f600://\U0001f600.com/\U0001f600"]


def test_url_verdicts_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    urls = list(ODD_URLS)
    hosts = ["alpha", "beta.news", "www.casino-win", "gamma", "adult-x", "m.delta", "pills"]
    for _ in range(400):
        urls.append(f"https://{hosts[rng.integers(len(hosts))]}.example.{['com', 'net', 'org'][rng.integers(3)]}/"
                    f"{['en', 'de', 'fr', 'es'][rng.integers(4)]}/{rng.integers(10_000)}{['', '?p=1', '#t', '.html'][rng.integers(4)]}")
    got = sorted(url_filter.judge(pages(spark, urls), URL_RULES).collect(), key=lambda r: r.page_id)
    assert [(r.host, r.path, r.rule, r.verdict) for r in got] == brute_judge(urls)
    assert {r.verdict for r in got if r.rule is None} == {"allow", "block"}
    assert all((r.score is None) == (r.rule is not None) for r in got)


@pytest.mark.parametrize("urls", [[], [None], ["http://a.org/x"], ["http://net/x", "http://net/x"], [None, "", "a://b"]])
def test_url_filter_without_labels(spark, urls):
    got = sorted(url_filter.judge(pages(spark, urls), URL_RULES).collect(), key=lambda r: r.page_id)
    assert [(r.host, r.path, r.rule, r.verdict) for r in got] == brute_judge(urls)


def test_url_filter_keeps_null_and_repeated_ids(spark):
    urls = ["http://a.org/x", "http://net/x", "http://a.org/x", None]
    got = url_filter.judge(pages(spark, urls, [None, 3, 3, None]), URL_RULES).collect()
    assert Counter((r.page_id, r.host) for r in got) == Counter([(None, "a.org"), (3, "net"), (3, "a.org"), (None, "")])


def test_url_model_salted_join_gives_the_same(spark, monkeypatch):
    urls = [f"https://h{i % 7}.example.{'net' if i % 3 else 'org'}/en/{i}" for i in range(60)] + ["http://xxx.org/a"] * 5
    want = sorted(map(tuple, url_filter.judge(pages(spark, urls), URL_RULES).collect()), key=str)
    monkeypatch.setattr(url_filter, "BROADCAST_STRINGS", 3)
    assert sorted(map(tuple, url_filter.judge(pages(spark, urls), URL_RULES).collect()), key=str) == want


def test_url_filter_plan_is_native(spark):
    df = url_filter.judge(pages(spark, ODD_URLS), URL_RULES)
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan


# --- spelling variants ----------------------------------------------------------------------

def docs(spark, texts, ids=None):
    return spark.createDataFrame([(t, i if ids is None else ids[i], "w", 1, 2, "f", "k") for i, t in enumerate(texts)], DOCS)


def brute_words(texts, ids=None):
    count = Counter()
    for i, text in enumerate(texts):
        own = i if ids is None else ids[i]
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if own is None else own}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(words):
    out = {}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None)
    return out


def variant_texts(rng, n=60):
    letters = "abcdeéàÿ"
    base = ["".join(letters[rng.integers(len(letters))] for _ in range(rng.integers(5, 12))) for _ in range(25)]
    words = list(base)
    for w in base * 4:
        k = rng.integers(len(w))
        c = letters[rng.integers(len(letters))]
        words.append([w[:k] + w[k + 1:], w[:k] + c + w[k + 1:], w[:k] + c + w[k:]][rng.integers(3)])
    texts = [" ".join(words[min(len(words) - 1, int(rng.exponential(40)))] for _ in range(80)) for _ in range(n)]
    return texts + [None, "", "éééééé×÷ ABCDE abcde Abcde", "z" * 20_000 + " " + "z" * 19_999, "z" * 20_000, "z" * 20_000,
                    "z" * 19_999 + "," + "z" * 19_999]


@pytest.mark.parametrize("hot", [64, 1, 0])
def test_spelling_equals_brute_force(spark, hot):
    texts = variant_texts(np.random.default_rng(2))
    got = spelling.variants(docs(spark, texts), hot=hot).collect()
    want = brute_variants(brute_words(texts))
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == want and len(got) == len(want)
    assert any(v[0] for v in want.values()) and any(v[1] != v[0] for v in want.values() if v[0])


@pytest.mark.parametrize("hot", [64, 0])
def test_spelling_pairs_in_a_hot_chunk(spark, hot):
    """Hundreds of words share their first and last halves: all and only true pairs remain."""
    words = ["commonhead" + a + b + c for a in "abcde" for b in "xyzuv" for c in ("q", "r", "", "qr")]
    words += [w[:3] + "X" + w[3:] for w in words[:7]] + ["X" + w for w in words[:5]] + ["aaaaa", "aaaaaa", "aaaaaaa", "baaaaa"]
    got = spelling.near_pairs(spark.createDataFrame([(w,) for w in words], "word string"), hot).collect()
    want = {frozenset((a, b)) for a in words for b in words if one_edit(a, b)}
    assert {frozenset(p) for p in got} == want and len(got) == len(want)


def test_spelling_odd_inputs(spark):
    assert spelling.variants(docs(spark, [])).count() == 0
    assert spelling.variants(docs(spark, [None, "", "12 ab"])).count() == 0
    texts = ["letter letter", "letter lettre", "letter", "lettre lettre"]
    ids = [None, 7, 7, None]
    got = spelling.variants(docs(spark, texts, ids)).collect()
    assert {r.word: r.n for r in got} == brute_words(texts, ids)


def test_spelling_roots_follow_long_chains(spark):
    links = [(f"w{i}", f"w{i + 1}") for i in range(37)] + [("other", "w5")]
    got = spelling.roots(spark.createDataFrame(links, "word string, form string")).collect()
    assert {r.word: r.root for r in got} == {a: "w37" for a, _ in links}


# --- periodic runs --------------------------------------------------------------------------

def brute_runs(words, least=12):
    n, found = len(words), {}
    for p in range(1, n // 2 + 1):
        t = 0
        while t < n - p:
            if words[t] != words[t + p]:
                t += 1
                continue
            s = t
            while t < n - p and words[t] == words[t + p]:
                t += 1
            if t - s + p >= max(least, 2 * p):
                found.setdefault((s, t - s + p), p)
    return sorted((s, m, p) for (s, m), p in found.items())


def thue_morse(n):
    return [bin(i).count("1") % 2 for i in range(n)]


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


@pytest.mark.parametrize("words", [thue_morse(400), fibonacci(400), [0] * 200, [0, 1] * 70, [0, 0, 1] * 50 + [0],
                                   list(range(9)) * 9 + list(range(9, 20)) * 5, thue_morse(64) * 3])
def test_runs_of_classic_words(words):
    assert sorted(map(tuple, periodic_runs.find_runs(np.array(words)).tolist())) == brute_runs(words)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=30), st.lists(st.integers(0, 3), min_size=1, max_size=25), st.integers(1, 6),
       st.lists(st.integers(0, 2), max_size=20))
def test_runs_of_any_word(head, unit, times, tail):
    words = head + unit * times + tail
    assert sorted(map(tuple, periodic_runs.find_runs(np.array(words)).tolist())) == brute_runs(words)


def brute_report(text, doc):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    n = len(words)
    h = 1 if doc is None else zlib.crc32(str(doc).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a, own = g % n, words
        p = 1 + (n - a) // (3 + g % 8)
        words = [own[a + (i - a) % p] if i >= a else own[i] for i in range(n)]
    runs = brute_runs(words)
    dropped = {i for s, m, p in runs for i in range(s + p, s + m)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    own = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    return (len(runs), *own, hashlib.sha256("".join(f"{s},{m},{p}\n" for s, m, p in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in dropped)).hexdigest())


def test_runs_report_equals_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(4)
    texts = [None, "", " \n", "a", "a " * 11, "a " * 12, "é 日本 " * 30, "x" * 50_000, "to be or not " * 400]
    for _ in range(160):
        words = [f"w{rng.integers(40)}" for _ in range(rng.integers(0, 90))]
        if rng.random() < .3 and words:
            words = words[:20] + words[20:26] * 4
        texts.append("  ".join(words) + "\u00a0")
    got = periodic_runs.report(docs(spark, texts)).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == {i: brute_report(t, i) for i, t in enumerate(texts)}
    assert {zlib.crc32(str(i).encode()) % 10 == 0 for i in range(len(texts))} == {True, False}


def test_runs_report_odd_rows(spark):
    assert periodic_runs.report(docs(spark, [])).count() == 0
    texts, ids = ["a b " * 9] * 3 + [None], [None, 9_007_199_254_740_993, 9_007_199_254_740_993, None]
    got = periodic_runs.report(docs(spark, texts, ids)).collect()
    assert Counter(map(tuple, got)) == Counter((i, *brute_report(t, i)) for t, i in zip(texts, ids, strict=True))


def test_runs_of_a_very_long_text():
    words = np.concatenate([np.arange(50_000), np.tile(np.arange(7_001), 20), np.zeros(100_000, int)])
    rows = periodic_runs.find_runs(words).tolist()
    assert rows == [[50_000, 140_021, 7_001], [190_020, 100_000, 1]]


# --- the registered queries ------------------------------------------------------------------

@needs_data
@pytest.mark.parametrize("name", ["op11_url_filter", "op12_spelling_variants"])
def test_queries_equal_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    rel = con.sql(queries.ORACLE[name])
    assert sorted(rel.columns) == sorted(df.columns)
    at = [rel.columns.index(c) for c in df.columns]

    def value(v):
        return round(v, 6) if isinstance(v, float) else v

    assert Counter(tuple(map(value, r)) for r in df.collect()) == Counter(tuple(value(r[i]) for i in at) for r in rel.fetchall())


@needs_data
def test_runs_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    short = [r for r in rows if len((r.text or "").split()) <= 600]
    got = {r.doc_id: tuple(r)[1:] for r in queries.QUERIES["op13_periodic_runs"](spark, SF).collect()}
    assert len(got) == len(rows) and len(short) > 100
    assert {r.doc_id: got[r.doc_id] for r in short} == {r.doc_id: brute_report(r.text, r.doc_id) for r in short}
