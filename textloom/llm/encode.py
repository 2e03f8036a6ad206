"""p7: token ids of a public byte-level BPE vocabulary, merged by recursive DuckDB queries inside the tasks.

Each Arrow batch is split into words by the vocabulary's own pattern; only words the Python worker has not met yet are
encoded. For those, token-position rows join the merge table and every word contracts its lowest-ranked pair until no pair
is left; an ordered aggregation returns the ids. Most text is repetition, so the recursive part sees few rows.

Long words (blobs, scripts without blanks) give the same ids in fewer steps. They are cut where no token of the vocabulary
that occurs in them reaches across, and one step contracts every pair that has the lowest rank as far as a token can reach:
a new token only enters pairs of higher rank, so nothing that happens farther away can take part in such a pair before.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The folder of the vocabularies; a parameter of every function here.
VOCABULARIES = "/opt/tokenizers"
#: Words a Python worker remembers (about 200 bytes each); beyond it the memory starts anew.
REMEMBERED_WORDS = 400_000
#: Characters of new words that go into one recursive query.
QUERY_CHARS = 4_000_000

_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_RECURSION = """
WITH RECURSIVE step(it, w, pos, tok) AS (
    SELECT 0, w, pos, tok FROM base
  UNION ALL
    (WITH near AS (
       SELECT it, w, pos, tok, {near} FROM step WINDOW o AS (PARTITION BY w ORDER BY pos)),
     ranked AS (
       -- a code orders pairs by rank and names both tokens and what they become
       SELECT n.*, min(m.code) OVER (PARTITION BY n.w) AS least
       FROM near n LEFT JOIN merges m ON m.l = n.tok AND m.r = n.nxt),
     live AS (
       SELECT *, (least >> 20) & 1048575 AS l, least & 1048575 AS r FROM ranked WHERE least IS NOT NULL),
     {marked}
     SELECT m.it + 1, m.w, m.pos, CASE WHEN m.head THEN x.made ELSE m.tok END
     FROM marked m JOIN merges x ON x.code = m.least WHERE NOT m.eaten))
SELECT w, list(tok ORDER BY pos) AS ids
FROM step JOIN (SELECT w, max(it) AS it FROM step GROUP BY w) USING (w, it) GROUP BY w ORDER BY w
"""
#: Of overlapping hits, a run of one token, the leftmost contracts.
_MERGE = _RECURSION.format(
    near="lead(tok) OVER o AS nxt, lag(tok) OVER o AS prv, lag(tok, 2) OVER o AS prv2",
    marked="""marked AS (
       SELECT *, tok = l AND nxt IS NOT DISTINCT FROM r AND (l <> r OR prv IS DISTINCT FROM tok) AS head,
              tok = r AND prv IS NOT DISTINCT FROM l AND (l <> r OR prv2 IS DISTINCT FROM prv) AS eaten FROM live)""",
)
#: For long words: a pair contracts when none within the reach of a token is lower. In a run of one token every second hit
#: does, from the left, once the run is settled from its first token on.
_MERGE_LONG = """
WITH RECURSIVE step(it, w, pos, tok) AS (
    SELECT 0, w, pos, tok FROM base
  UNION ALL
    (WITH near AS (
       SELECT it, w, pos, tok, lead(tok) OVER o AS nxt, row_number() OVER o AS s FROM step WINDOW o AS (PARTITION BY w ORDER BY pos)),
     ranked AS (
       SELECT n.*, m.code, m.made, m.code IS NOT NULL AND m.code = min(m.code) OVER (PARTITION BY n.w ORDER BY n.pos RANGE BETWEEN {reach} PRECEDING AND {twice} FOLLOWING) AS hit,
              count(m.code) OVER (PARTITION BY n.w) AS pairs
       FROM near n LEFT JOIN merges m ON m.l = n.tok AND m.r = n.nxt),
     runs AS (
       SELECT *, coalesce(max(CASE WHEN NOT hit THEN 2 * s + CAST(tok IS NOT DISTINCT FROM nxt AS INTEGER) END)
                          OVER (PARTITION BY w ORDER BY pos), 0) AS before
       FROM ranked WHERE pairs > 0),
     heads AS (
       SELECT *, hit AND (tok <> nxt OR before % 2 = 0 AND (s - before // 2) % 2 = 1) AS head FROM runs),
     marked AS (SELECT *, lag(head, 1, false) OVER (PARTITION BY w ORDER BY pos) AS eaten FROM heads)
     SELECT it + 1, w, pos, CASE WHEN head THEN made ELSE tok END FROM marked WHERE NOT eaten))
SELECT w, list(tok ORDER BY pos) AS ids
FROM step JOIN (SELECT w, max(it) AS it FROM step GROUP BY w) USING (w, it) GROUP BY w ORDER BY w
"""
#: Bytes from which a word counts as long.
LONG_WORD = 64
#: Bytes of long words that go into one recursive query, but for one word alone; their steps keep some 20 bytes per token.
LONG_QUERY_BYTES = 1_000_000
#: Token ids that the remembered words may hold in all.
REMEMBERED_IDS = 40_000_000
#: Longest tokens that are looked for by hash; longer ones, which are few, are looked for one by one.
HASHED_BYTES = 16
_BASE = 0x100000001B3


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in the vocabulary file: bytes that print keep theirs, the others
    follow from 256 on in byte order."""
    out, n = [], 0
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out.append(chr(b))
        else:
            out.append(chr(256 + n))
            n += 1
    return out


class Vocabulary:
    """Merge table of one vocabulary file, held by a Python worker."""

    _loaded: dict[str, Vocabulary] = {}

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def __init__(self, path: str):
        import duckdb
        import regex

        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.letters = byte_letters()
        self.byte_id = np.array([self.vocab[c] for c in self.letters], np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "1GB", "temp_directory": ""})
        merges = pa.table({  # noqa: F841 - read by name
            "l": pa.array([self.vocab[a] for a, _ in pairs], pa.int32()),
            "r": pa.array([self.vocab[b] for _, b in pairs], pa.int32()),
            "code": pa.array([k << 40 | self.vocab[a] << 20 | self.vocab[b] for k, (a, b) in enumerate(pairs)], pa.int64()),
            "made": pa.array([self.vocab[a + b] for a, b in pairs], pa.int32()),
        })
        self.db.execute("CREATE TABLE merges AS SELECT * FROM merges")
        self.known: dict[str, array] = {}
        self.held = 0
        # whether every merge comes after those that make its parts
        made: dict[str, int] = {}
        for k, (a, b) in enumerate(pairs):
            made[a + b] = k
        self.ordered = all(made.get(a, -1) < k and made.get(b, -1) < k for k, (a, b) in enumerate(pairs))
        self.made = made
        self.any_text = regex.compile(_SPLIT).findall
        # the same pattern for texts below U+0250, where the classes can be listed and the faster engine used
        low = [chr(c) for c in range(0x250)]
        letters = "".join(c for c in low if regex.match(r"\p{L}", c))
        digits = "".join(c for c in low if regex.match(r"\p{N}", c))
        own = _SPLIT.replace(r"[^\s\p{L}\p{N}]", rf"[^\s{letters}{digits}]").replace(r"\p{L}", f"[{letters}]").replace(r"\p{N}", f"[{digits}]")
        self.low_text = re.compile(own).findall
        self.beyond_low = re.compile("[ɐ-\U0010ffff\x1c-\x1f\x85]").search

    def words(self, text: str) -> list[str]:
        return self.any_text(text) if self.beyond_low(text) else self.low_text(text)

    def _tokens(self) -> tuple[dict[int, np.ndarray], list[bytes]]:
        """Made tokens by their length in bytes as sorted hashes, and those too long for that."""
        if "by_length" not in self.__dict__:
            byte = {c: b for b, c in enumerate(self.letters)}
            raw = [bytes(map(byte.__getitem__, t)) for t in self.made]
            lengths: dict[int, list[bytes]] = {}
            for t in raw:
                lengths.setdefault(len(t), []).append(t)
            self.by_length = {n: np.unique(_hashes(np.frombuffer(b"".join(ts), np.uint8).reshape(-1, n), n)) for n, ts in lengths.items() if n <= HASHED_BYTES}
            self.longer = [t for n, ts in lengths.items() if n > HASHED_BYTES for t in ts]
        return self.by_length, self.longer

    def pieces(self, raw: bytes) -> tuple[list[bytes], int]:
        """A long word cut where no token that occurs in it reaches across, and the length of its longest token."""
        by_length, longer = self._tokens()
        flat = np.frombuffer(raw, np.uint8)
        inside = np.zeros(len(flat) + 1, np.int64)
        reach = 1
        for n, known in by_length.items():
            if n > len(flat):
                continue
            h = _hashes(np.lib.stride_tricks.sliding_window_view(flat, n), n)
            at = np.flatnonzero(known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h)
            if len(at):
                reach = max(reach, n)
                np.add.at(inside, at + 1, 1)
                np.add.at(inside, at + n, -1)
        for t in longer:
            at = raw.find(t)
            while at >= 0:
                reach = max(reach, len(t))
                inside[at + 1] += 1
                inside[at + len(t)] -= 1
                at = raw.find(t, at + 1)
        cuts = np.flatnonzero(np.cumsum(inside)[1:-1] == 0) + 1
        ends = [0, *cuts.tolist(), len(raw)]
        return [raw[a:b] for a, b in zip(ends, ends[1:])], reach

    def _contract(self, raw: list[bytes], query: str) -> list[array]:
        lens = np.fromiter(map(len, raw), np.int64, len(raw))
        flat = np.frombuffer(b"".join(raw), np.uint8)
        w = np.repeat(np.arange(len(raw), dtype=np.int32), lens)
        pos = (np.arange(len(flat)) - np.repeat(np.cumsum(lens) - lens, lens)).astype(np.int32)
        base = pa.table({"w": w, "pos": pos, "tok": self.byte_id[flat]})  # noqa: F841 - read by name
        found = self.db.sql(query).to_arrow_table()["ids"].combine_chunks()
        if isinstance(found, pa.ChunkedArray):
            found = pa.concat_arrays(found.chunks)
        ids, cuts = found.flatten().to_numpy(), np.concatenate([[0], np.cumsum(np.diff(found.offsets.to_numpy()))])
        return [array("i", ids[a:b].tobytes()) for a, b in zip(cuts[:-1], cuts[1:])]

    def _learn_long(self, words: list[bytes]) -> list[array]:
        """Ids of long words, by their pieces; pieces that come again are contracted once."""
        cut, reach = [], 1
        for raw in words:
            parts, r = self.pieces(raw) if self.ordered else ([raw], 1 << 30)
            cut.append(parts)
            reach = max(reach, r)
        new = sorted({p for parts in cut for p in parts}, key=lambda p: (len(p), p))
        short = [p for p in new if len(p) < LONG_WORD]
        ids = dict(zip(short, self._contract(short, _MERGE))) if short else {}
        rest = new[len(short) :]
        if rest:
            ids.update(zip(rest, self._contract(rest, _MERGE_LONG.format(reach=reach, twice=2 * reach))))
        out = []
        for parts in cut:
            one = array("i")
            for p in parts:
                one += ids[p]
            out.append(one)
        return out

    def learn(self, words: list[str]) -> None:
        """Encode words not met before."""
        raw = [(w, w.encode("utf-8", "surrogatepass")) for w in words]
        for long in (False, True):
            some = [x for x in raw if (len(x[1]) >= LONG_WORD) == long]
            most, at = LONG_QUERY_BYTES if long else QUERY_CHARS, 0
            while at < len(some):
                end, size = at, 0
                while end < len(some) and (end == at or size + len(some[end][1]) <= most):
                    size += len(some[end][1])
                    end += 1
                part = [r for _, r in some[at:end]]
                for (word, _), ids in zip(some[at:end], self._learn_long(part) if long else self._contract(part, _MERGE)):
                    self.known[word] = ids
                    self.held += len(ids)
                at = end

    def encode_batch(self, texts: list[str | None]) -> pa.ListArray:
        split = [self.words(t) if t else [] for t in texts]
        new = set().union(*split).difference(self.known) if split else set()
        if len(self.known) + len(new) > REMEMBERED_WORDS or self.held > REMEMBERED_IDS:
            new = set().union(*split)
            self.known.clear()
            self.held = 0
        if new:
            self.learn(sorted(new))
        out, known, cuts = array("i"), self.known, [0]
        for words in split:
            for w in words:
                out += known[w]
            cuts.append(len(out))
        return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(np.frombuffer(out, np.int32)))


def _hashes(windows: np.ndarray, n: int) -> np.ndarray:
    """64-bit hash of each row of ``n`` bytes."""
    h = np.zeros(len(windows), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            h = h * np.uint64(_BASE) + windows[:, k] + np.uint64(1)
    return h


def _stage(path: str):
    def run(batches):
        v = Vocabulary.load(path)
        for b in batches:
            # pieces of bounded size keep the offsets in 32 bits and the worker's memory small
            texts, start = b.column(1).to_pylist(), 0
            while start < len(texts):
                end, size = start, 0
                while end < len(texts) and (end == start or size < 16_000_000):
                    size += len(texts[end] or "")
                    end += 1
                yield pa.RecordBatch.from_arrays([b.column(0).slice(start, end - start), v.encode_batch(texts[start:end])], names=["doc_id", "ids"])
                start = end

    return run


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = "byte_bpe_50k", folder: str = VOCABULARIES) -> DataFrame:
    """``doc_id, ids``: one row per document, in any order, without special tokens.

    A null text and an empty text give the empty list; blank texts and strings of special tokens are encoded like any
    other. Repeated rows give repeated rows. An empty table gives an empty one. No row is ever cut.
    """
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return picked.mapInArrow(_stage(f"{folder}/{vocabulary}.json"), "doc_id long, ids array<int>")


def _decode_stage(path: str):
    def run(batches):
        v = Vocabulary.load(path)
        letter = {c: b for b, c in enumerate(v.letters)}
        if "pieces" not in v.__dict__:
            v.pieces = True
            pieces = pa.table({"id": pa.array(v.vocab.values(), pa.int32()), "hex": pa.array([bytes(letter.get(c, 63) for c in t).hex() for t in v.vocab])})  # noqa: F841
            v.db.execute("CREATE TABLE pieces AS SELECT * FROM pieces")
        for b in batches:
            rows = pa.table({"k": pa.array(range(b.num_rows), pa.int32()), "ids": b.column(1)})  # noqa: F841
            out = v.db.execute(
                """SELECT r.k, decode(unhex(coalesce(string_agg(p.hex, '' ORDER BY u.pos), ''))) AS text
                   FROM rows r LEFT JOIN (SELECT k, unnest(ids) AS id, generate_subscripts(ids, 1) AS pos FROM rows) u ON u.k = r.k
                   LEFT JOIN pieces p ON p.id = u.id GROUP BY r.k ORDER BY r.k"""
            ).to_arrow_table()["text"].combine_chunks()
            yield pa.RecordBatch.from_arrays([b.column(0), out.cast(pa.string()) if not isinstance(out, pa.ChunkedArray) else pa.concat_arrays(out.chunks).cast(pa.string())], names=["doc_id", "text"])

    return run


def decode(encoded: DataFrame, vocabulary: str = "byte_bpe_50k", folder: str = VOCABULARIES) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids`` by an ordered aggregation of the ids' bytes; the empty list gives ``''``."""
    return encoded.select("doc_id", "ids").mapInArrow(_decode_stage(f"{folder}/{vocabulary}.json"), "doc_id long, text string")
