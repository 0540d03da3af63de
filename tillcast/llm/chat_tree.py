"""Chat formatting as prefix trees: conversations that begin with the same turns share
them, and the shared turns are written once.

A turn is written ``### <role>: <text></turn>`` and a line feed. Inside roles and texts
``\\``, ``#`` and ``</turn`` (in roles also ``:``) get a backslash, so no control string
occurs in them and taking the backslashes out gives back the text.

Conversations are sorted by the hashes of their successive prefixes, which lays them out
depth-first; each writes only the turns it does not share with the one before it. The
output is cut into segments (one row each, one training sequence): the segment's text and,
per node (turn), its place in the text, its parent, the position id of its first
character (its distance from the root along its own branch), the character intervals of
its ancestors, which it may attend to beside itself, and its part under the loss mask
(the assistant's text). A segment starts with a whole branch, so it can be read alone;
shared turns are written once per segment. Offsets count code points.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

OPEN, CLOSE = "### ", "</turn>\n"
ANSWERING_ROLE = "assistant"
# A segment is closed once it holds this many characters or conversations.
SEGMENT_CHARS, SEGMENT_CONVERSATIONS = 1 << 18, 2048

_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"### ((?:\\.|[^\\:])*): (.*?)</turn>\n", re.DOTALL)

CHAIN_SCHEMA = "conv_id long, path binary, roles array<string>, texts array<string>"
SEGMENT_SCHEMA = ("text string, node_start array<int>, node_end array<int>, node_parent array<int>, "
                  "node_position array<int>, node_attends array<array<int>>, loss_start array<int>, "
                  "loss_end array<int>, conv_ids array<long>, conv_leaf array<int>")
DIGEST_SCHEMA = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                 "formatted_chars long")


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("#", "\\#").replace("</turn", "<\\/turn")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The written turn and the bounds of its text inside it."""
    head = OPEN + escape(role).replace(":", "\\:") + ": "
    body = escape(text)
    return head + body + CLOSE, len(head), len(head) + len(body)


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    return [(unescape(r), unescape(t)) for r, t in _TURN.findall(formatted)]


def prefix_chains(turns: DataFrame) -> DataFrame:
    """``turns(conv_id, turn, role, text, …)`` → one row per conversation
    (``CHAIN_SCHEMA``): its turns in order and ``path``, eight bytes per turn, the hash of
    the conversation up to that turn.

    Order: by turn, a null turn first, equal turns by role and text. Null role or text is
    empty; a null ``conv_id`` is a conversation like any other. Rows stream through the
    task sorted; only the conversation at hand is held."""
    def run(batches):
        names = ["conv_id", "path", "roles", "texts"]
        kinds = [pa.int64(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.string())]
        current, roles, texts, begun = None, [], [], False
        done, size = [], 0

        def flush():
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)], names=names)

        def close():
            digest, path = b"", []
            for role, text in zip(roles, texts, strict=True):
                h = hashlib.blake2b(digest, digest_size=8)
                for part in (role, text):
                    raw = part.encode()
                    h.update(len(raw).to_bytes(8, "little") + raw)
                digest = h.digest()
                path.append(digest)
            done.append((current, b"".join(path), roles, texts))

        for batch in batches:
            for conv, role, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if not begun or conv != current:
                    if begun:
                        close()
                    current, roles, texts, begun = conv, [], [], True
                    if size > 4 << 20 or len(done) >= 4096:
                        yield flush()
                        done, size = [], 0
                roles.append(role)
                texts.append(text)
                size += len(text)
        if begun:
            close()
            yield flush()

    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), text("role").alias("role"),
                        text("text").alias("text"), F.col("turn").cast("long").alias("turn"))
    return (rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .select("conv_id", "role", "text").mapInArrow(run, CHAIN_SCHEMA))


class _Segment:
    """A segment being written: its text and the branch open at its end."""

    def __init__(self):
        self.parts, self.size = [], 0
        self.start, self.end, self.parent, self.position, self.attends = [], [], [], [], []
        self.loss_start, self.loss_end, self.conv_ids, self.leaf = [], [], [], []
        self.branch: list[tuple[str, str, int]] = []     # role, text, node

    def add(self, conv_id, roles, texts) -> None:
        keep = 0
        for (role, text, _), r, t in zip(self.branch, roles, texts, strict=False):
            if role != r or text != t:
                break
            keep += 1
        del self.branch[keep:]
        for role, text in list(zip(roles, texts, strict=True))[keep:]:
            parent = self.branch[-1][2] if self.branch else -1
            written, low, high = format_turn(role, text)
            node, at = len(self.start), self.size
            self.start.append(at)
            self.end.append(at + len(written))
            self.parent.append(parent)
            self.position.append(self.position[parent] + self.end[parent] - self.start[parent] if self.branch else 0)
            seen = list(self.attends[parent]) if self.branch else []
            if self.branch:
                if seen and seen[-1] == self.start[parent]:
                    seen[-1] = self.end[parent]
                else:
                    seen += [self.start[parent], self.end[parent]]
            self.attends.append(seen)
            answers = role == ANSWERING_ROLE
            self.loss_start.append(at + low if answers else at)
            self.loss_end.append(at + high if answers else at)
            self.branch.append((role, text, node))
            self.parts.append(written)
            self.size += len(written)
        self.conv_ids.append(conv_id)
        self.leaf.append(self.branch[-1][2] if self.branch else -1)

    def row(self) -> tuple:
        return ("".join(self.parts), self.start, self.end, self.parent, self.position, self.attends,
                self.loss_start, self.loss_end, self.conv_ids, self.leaf)


def segments(chains: DataFrame, chars: int = SEGMENT_CHARS, conversations: int = SEGMENT_CONVERSATIONS) -> DataFrame:
    """Chains → ``SEGMENT_SCHEMA``. Range partitions by (path, conv_id), so neither a first
    turn shared by many conversations nor many copies of one makes a large task."""
    ints, lists = pa.list_(pa.int32()), pa.list_(pa.list_(pa.int32()))
    kinds = [pa.string(), ints, ints, ints, ints, lists, ints, ints, pa.list_(pa.int64()), ints]
    names = [c.split()[0] for c in SEGMENT_SCHEMA.split(", ")]

    def write(own: _Segment):
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(own.row(), kinds, strict=True)],
                                          names=names)

    def run(batches):
        own = _Segment()
        for batch in batches:
            for conv, roles, texts in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                own.add(conv, roles, texts)
                if own.size >= chars or len(own.conv_ids) >= conversations:
                    yield write(own)
                    own = _Segment()
        if own.conv_ids:
            yield write(own)

    return (chains.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
            .select("conv_id", "roles", "texts").mapInArrow(run, SEGMENT_SCHEMA))


def write_chat(turns: DataFrame, folder: str) -> None:
    segments(prefix_chains(turns)).write.option("compression", "zstd").parquet(folder)


def conversation_texts(segment: dict):
    """Per conversation of a stored segment: its id, written text and the parts of the
    segment's text under its loss mask, all from root to leaf."""
    text, start, end, parent = (segment[c] for c in ("text", "node_start", "node_end", "node_parent"))
    for conv, node in zip(segment["conv_ids"], segment["conv_leaf"], strict=True):
        branch = []
        while node >= 0:
            branch.append(node)
            node = parent[node]
        branch.reverse()
        yield (conv, "".join([text[start[n]:end[n]] for n in branch]),
               [text[segment["loss_start"][n]:segment["loss_end"][n]] for n in branch])


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """Reads the stored segments back: ``DIGEST_SCHEMA``, one row per conversation."""
    names = [c.split()[0] for c in DIGEST_SCHEMA.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def sha(text: str) -> str:
        return hashlib.sha256(text.encode()).hexdigest()

    def run(batches):
        for batch in batches:
            for segment in batch.to_pylist():
                rows = []
                for conv, written, loss in conversation_texts(segment):
                    turns, under = parse_turns(written), "".join(map(unescape, loss))
                    rows.append((conv, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(under),
                                 sha(under), len(written)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    stored = spark.read.schema(SEGMENT_SCHEMA).parquet(folder)
    return stored.select("text", "node_start", "node_end", "node_parent", "loss_start", "loss_end", "conv_ids",
                         "conv_leaf").mapInArrow(run, DIGEST_SCHEMA)
