"""Byte-level BPE as recursive DuckDB queries, one DuckDB per task (operator 3).

The words of a batch that are not a vocabulary entry themselves become rows (word, position,
token), one per byte. A recursive query joins neighbouring tokens with the merge table, takes
each word's leftmost pair of the smallest rank, writes the merged token in its place and goes
on with the words that still had a pair; the last state of a word is its encoding. A second
query decodes by an ordered aggregation of the tokens' bytes.

The merge table has a row for every way to split a vocabulary entry into two entries; its
rank is that of the whole. Words of over `LONG` bytes use a variant that contracts all
non-overlapping pairs of that rank at once, from the left, where no pair that the merged token
can be part of has a smaller rank: then single contractions would come in that order anyhow.

Texts are cut into parts as in `tokens`; a bounded table keeps the results of pieces, so a
word is sent to DuckDB about once per task, and texts are laid out from the results at once. Null and empty texts have no ids. Other columns
are ignored, repeated rows are encoded again, an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.tokens import are_words, cuttable, gathered, split_parts, split_signs

LONG = 48
WORDS_AT_ONCE = 20_000

# One contraction per word and round. A row's key is word * 64 + position; `nxt` is the key of
# the row behind it, so neighbours meet by a join. A merge's code is rank * 64 + position: the
# smallest of a word is its leftmost pair of the smallest rank.
SHORT_SQL = """
WITH RECURSIVE step AS (
    SELECT key, tok, nxt, 0 AS round FROM start_tokens
    UNION ALL
    (WITH pairs AS (
        SELECT s.key, s.tok, s.nxt, s.round, n.tok AS next_tok, n.nxt AS after
        FROM step s LEFT JOIN step n ON n.key = s.nxt
    ), best AS (
        SELECT p.key >> 6 AS word, min(m.merged * 64 + (p.key & 63)) AS code, arg_min(p.nxt, m.merged * 64 + (p.key & 63)) AS absorbed
        FROM pairs p JOIN merges m ON m.pair = (p.tok << 32) + p.next_tok GROUP BY p.key >> 6
    )
    SELECT p.key, CASE WHEN p.key & 63 = b.code & 63 THEN b.code >> 6 ELSE p.tok END AS tok,
           CASE WHEN p.key & 63 = b.code & 63 THEN p.after ELSE p.nxt END AS nxt, p.round + 1
    FROM pairs p JOIN best b ON p.key >> 6 = b.word WHERE p.key <> b.absorbed)
), last AS (SELECT key >> 6 AS word, max(round) AS round FROM step GROUP BY key >> 6)
SELECT l.word, s.key & 63 AS pos, s.tok FROM step s JOIN last l ON s.key >> 6 = l.word AND s.round = l.round
"""

# All pairs of the smallest rank at once where that is safe, else the leftmost one.
LONG_SQL = """
WITH RECURSIVE step AS (
    SELECT word, pos, tok, 0 AS round FROM start_tokens
    UNION ALL
    (WITH pairs AS (
        SELECT s.word, s.pos, s.tok, s.round, m.merged, m.safe
        FROM (SELECT *, lead(tok) OVER (PARTITION BY word ORDER BY pos) AS next_tok FROM step) s
        LEFT JOIN merges m ON m.l = s.tok AND m.r = s.next_tok
    ), best AS (
        SELECT word, min(merged) AS merged FROM pairs GROUP BY word HAVING min(merged) IS NOT NULL
    ), marked AS (
        SELECT p.word, p.pos, p.tok, p.round, b.merged, p.safe, coalesce(p.merged = b.merged, false) AS hit,
               row_number() OVER (PARTITION BY p.word ORDER BY p.pos) AS place
        FROM pairs p JOIN best b ON p.word = b.word
    ), counted AS (
        SELECT *, row_number() OVER (PARTITION BY word, hit ORDER BY pos) AS nth FROM marked
    ), chosen AS (
        SELECT *, hit AND CASE WHEN safe THEN (row_number() OVER (PARTITION BY word, hit, place - nth ORDER BY pos)) % 2 = 1 ELSE nth = 1 END AS merge
        FROM counted
    )
    SELECT word, pos, CASE WHEN merge THEN merged ELSE tok END, round + 1
    FROM (SELECT *, lag(merge, 1, false) OVER (PARTITION BY word ORDER BY pos) AS absorbed FROM chosen) WHERE NOT absorbed)
), last AS (SELECT word, max(round) AS round FROM step GROUP BY word)
SELECT s.word, s.pos, s.tok FROM step s JOIN last l ON s.word = l.word AND s.round = l.round
"""

DECODE_SQL = """
SELECT CAST(e.word AS BIGINT) AS word, string_agg(CAST(e.tok AS VARCHAR) || ',', '' ORDER BY e.pos) AS ids, count(*) AS n,
       unhex(string_agg(v.bytes, '' ORDER BY e.pos)) AS decoded
FROM encoded e JOIN vocabulary v ON v.tok = e.tok GROUP BY e.word ORDER BY e.word
"""


@lru_cache(maxsize=2)
def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def merge_table(ranks: dict[bytes, int]) -> pa.Table:
    """l, r, both as one number, merged, safe: the entry's rank, and whether no pair that holds it has a smaller one."""
    rows = [(l, r, rank) for entry, rank in ranks.items() for i in range(1, len(entry)) if (l := ranks.get(entry[:i])) is not None and (r := ranks.get(entry[i:])) is not None]
    least = np.full(max(ranks.values()) + 1, np.iinfo(np.int64).max)
    for l, r, rank in rows:
        least[l] = min(least[l], rank)
        least[r] = min(least[r], rank)
    l, r, merged = np.array(rows, np.int64).reshape(-1, 3).T
    return pa.table({"l": l, "r": r, "pair": (l << 32) + r, "merged": merged, "safe": least[merged] > merged})


class DuckCoder:
    """Encodings of pieces of the pattern, and of texts laid out from them: ids as decimals with a
    comma behind each, their number, and the decoded bytes. At most about `keep` different pieces
    are held; then all are forgotten, before the next batch."""

    def __init__(self, ranks_path: str, pattern: str, keep: int = 400_000):
        self.ranks, self.pattern, self.keep = read_ranks(ranks_path), regex.compile(pattern), keep
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "400MB"})
        self.db.register("merge_rows", merge_table(self.ranks))
        self.db.register("vocabulary_rows", pa.table({"tok": pa.array(self.ranks.values(), pa.int64()), "bytes": [k.hex() for k in self.ranks]}))
        self.db.execute("CREATE TABLE merges AS SELECT * FROM merge_rows; CREATE TABLE vocabulary AS SELECT * FROM vocabulary_rows")
        self.forget()

    def forget(self) -> None:
        """Drop the tables: idle Python workers of an executor should hold little."""
        self.number: dict[str, int] = {}
        self.ids, self.decoded = pa.array([], pa.large_binary()), pa.array([], pa.large_binary())
        self.counts = np.empty(0, np.int64)

    def _contract(self, words: list[bytes], sql: str) -> None:
        """Append the encodings of words, numbered from 0, to the table `encoded`."""
        lengths = np.array([len(w) for w in words])
        ends = np.cumsum(lengths)
        tokens = self.single[np.frombuffer(b"".join(words), np.uint8)].astype(np.int64)
        word = np.repeat(np.arange(len(words)), lengths)
        pos = np.arange(len(tokens)) - np.repeat(ends - lengths, lengths)
        if sql is SHORT_SQL:
            final = np.zeros(len(tokens), bool)
            final[ends - 1] = True
            rows = {"key": word * 64 + pos, "tok": tokens, "nxt": pa.array(word * 64 + pos + 1, mask=final)}
        else:
            rows = {"word": word, "pos": pos, "tok": tokens}
        self.db.register("start_tokens", pa.table(rows))
        self.db.execute(f"CREATE OR REPLACE TEMP TABLE encoded AS {sql}")
        self.db.unregister("start_tokens")

    def _add(self, pieces: list[str]) -> None:
        """Encode new pieces and number them."""
        whole, short, long = [], [], []
        for piece in pieces:
            raw = piece.encode()
            (whole if raw in self.ranks else short if len(raw) <= LONG else long).append((piece, raw))
        parts = []
        if whole:
            self.db.register("found", pa.table({"word": np.arange(len(whole), dtype=np.int32), "tok": pa.array([self.ranks[r] for _, r in whole], pa.int32())}))
            self.db.execute("CREATE OR REPLACE TEMP TABLE encoded AS SELECT word, 0 AS pos, tok FROM found")
            self.db.unregister("found")
            parts.append(self.db.sql(DECODE_SQL).to_arrow_table())
        for group, sql, size in ((short, SHORT_SQL, WORDS_AT_ONCE), (long, LONG_SQL, 200)):
            for at in range(0, len(group), size):
                self._contract([r for _, r in group[at : at + size]], sql)
                parts.append(self.db.sql(DECODE_SQL).to_arrow_table())
        at = len(self.number)
        self.number.update((piece, at + i) for i, (piece, _) in enumerate([*whole, *short, *long]))
        found = pa.concat_tables(parts).combine_chunks()
        column = lambda c: found.column(c).combine_chunks().cast(pa.large_binary())
        self.ids, self.decoded = (pa.concat_arrays([held, column(c)]) for held, c in ((self.ids, "ids"), (self.decoded, "decoded")))
        self.counts = np.concatenate([self.counts, found.column("n").to_numpy()])

    def _numbers(self, pieces: list[str]) -> np.ndarray:
        found = list(map(self.number.get, pieces))
        if None in found:
            self._add(list(dict.fromkeys(p for p, n in zip(pieces, found, strict=True) if n is None)))
            found = list(map(self.number.__getitem__, pieces))
        return np.array(found, np.int64)

    def encode(self, texts: list[str | None]) -> list[tuple[bytes, int, bytes]]:
        """Encodings of whole texts. A text's different parts are words with signs behind them, one
        piece each, or lists of the pattern's pieces; texts that can't be cut are such a list as a whole."""
        if len(self.number) > self.keep:
            self.forget()
        out: list[tuple[bytes, int, bytes]] = [(b"", 0, b"")] * len(texts)
        easy = [i for i, t in enumerate(texts) if t and cuttable(t)]
        hard = [i for i, t in enumerate(texts) if t and not cuttable(t)]
        if not easy and not hard:
            return out
        own, first = np.empty(0, np.int64), np.empty(0, np.int64)
        if easy:
            split = split_parts([texts[i] for i in easy])
            words, signs = (x.dictionary_encode() for x in split_signs(split.parts))
            lists = [[" " + w] if plain else self.pattern.findall(" " + w) for w, plain in zip(words.dictionary.to_pylist(), are_words(words.dictionary).to_pylist(), strict=True)]
            lists += [[x] if x else [] for x in signs.dictionary.to_pylist()]
            after = len(lists)
            lists += [self.pattern.findall(x) for x in split.heads]
            lists.append([])
            pairs = np.column_stack([words.indices.to_numpy(), signs.indices.to_numpy() + len(words.dictionary)])
            alone = np.column_stack([np.arange(len(split.heads)) + after, np.full(len(split.heads), len(lists) - 1)])
            own, first = np.concatenate([pairs, alone])[split.own].ravel(), 2 * split.first
        else:
            lists = []
        first = np.concatenate([first, len(own) + np.arange(len(hard))])
        own = np.concatenate([own, len(lists) + np.arange(len(hard))])
        lists += [self.pattern.findall(texts[i]) for i in hard]
        counts = np.array([len(x) for x in lists])
        pieces = self._numbers([p for x in lists for p in x])
        at, ends = gathered(counts, own)
        laid = pieces[at]
        cuts = np.concatenate([[0], ends[first[1:] - 1], [len(laid)]])
        total = np.concatenate([[0], np.cumsum(self.counts[laid])])[cuts]
        (ids, places), (decoded, spots) = (_bytes_of(c, laid, cuts) for c in (self.ids, self.decoded))
        for j, i in enumerate(easy + hard):
            out[i] = (ids[places[j] : places[j + 1] - 1].to_pybytes(), int(total[j + 1] - total[j]), decoded[spots[j] : spots[j + 1]].to_pybytes())
        return out


def _bytes_of(column: pa.LargeBinaryArray, chosen: np.ndarray, cuts: np.ndarray) -> tuple[pa.Buffer, list[int]]:
    """The chosen values end to end, and where the values at `cuts` begin."""
    taken = column.take(pa.array(chosen))
    offsets = np.frombuffer(taken.buffers()[1], np.int64)[taken.offset : taken.offset + len(chosen) + 1]
    return taken.buffers()[2] or pa.py_buffer(b""), offsets[cuts].tolist()


@lru_cache(maxsize=1)
def coder(ranks_path: str, pattern: str) -> DuckCoder:
    return DuckCoder(ranks_path, pattern)


BATCH_CHARS = 6_000_000


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """Key, n_tokens, ids_sha256 (of decimal ids joined by commas), decoded_sha256, and with
    `with_ids` the ids and the decoded bytes themselves."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def groups(texts: list[str | None]) -> Iterator[list[str | None]]:
        """Stretches of about `BATCH_CHARS` characters or one text."""
        own, size = [], 0
        for t in texts:
            own.append(t)
            size += len(t or "")
            if size >= BATCH_CHARS:
                yield own
                own, size = [], 0
        if own:
            yield own

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        duck = coder(ranks_path, pattern)
        for batch in batches:
            at = 0
            for own in groups(batch.column("text").to_pylist()):
                found = duck.encode(own)
                out = {"key": batch.column("key").slice(at, len(own)), "n_tokens": pa.array([x[1] for x in found], pa.int64()), "ids_sha256": [hashlib.sha256(x[0]).hexdigest() for x in found], "decoded_sha256": [hashlib.sha256(x[2]).hexdigest() for x in found]}
                if with_ids:
                    out |= {"ids": pa.array([list(map(int, x[0].split(b","))) if x[0] else [] for x in found], pa.list_(pa.int32())), "decoded": pa.array([x[2] for x in found], pa.binary())}
                yield pa.RecordBatch.from_pydict(out)
                at += len(own)
        duck.forget()

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded binary" * with_ids)
