"""Packing by non-negative least squares (operator 8).

Documents become token ids with an end id and are cut at multiples of the window; the pieces
are packed into sequences of at most `window` ids. Short pieces are counted by their length,
others by their length rounded up to `quantum`, so the histogram has a few hundred rows whatever
the corpus. All combinations of at most `depth` lengths that fill a window exactly are
enumerated; non-negative least squares finds how often each is repeated so that together they
use up the histogram; repeats are rounded down, and what is left is packed greedily, the largest
first. The plan is a short list of (combination, repeats): each piece finds its place in it from
its rank among the pieces of its length, so pieces are never gathered.

*Cuts.* A piece that nothing complements, so that its sequence would keep more than
window / `SLACK` ids of padding, goes into a stream: such pieces lie end to end by the running
sum of their lengths, and are cut where a window ends. So any lengths fill their sequences.

Defined cases: null and empty texts are one piece with the end id alone; a repeated row is
packed again; an empty table gives no pieces. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.prefix import prefix_sums
from millrace.llm.token_files import encoder, id_type
from millrace.llm.words import stretches
from millrace.session import materialize

Plan = list[tuple[tuple[int, ...], int]]


SLACK = 64
STRETCH_BYTES = 1_000_000
EXACT = 64  # lengths up to this are counted as they are


def sizes_of(lengths: np.ndarray, quantum: int) -> np.ndarray:
    """Lengths as they are counted."""
    return np.where(lengths <= EXACT, lengths, -(-lengths // quantum) * quantum)


def combinations(window: int, depth: int = 3, present: np.ndarray | None = None) -> list[tuple[int, ...]]:
    """Multisets of at most `depth` of the present sizes, largest first, whose sum is `window`."""
    own = sorted(range(1, window + 1) if present is None else present.tolist(), reverse=True)
    known = set(own)

    def grow(head: tuple[int, ...], left: int) -> Iterator[tuple[int, ...]]:
        most = min(left, head[-1] if head else left)
        if 0 < left <= most and left in known:
            yield (*head, left)
        if len(head) + 1 < depth:
            more = depth - len(head) - 1
            for nxt in own:
                if nxt < left and nxt <= most and left - nxt <= nxt * more:
                    yield from grow((*head, nxt), left - nxt)

    return list(grow((), window))


def nonnegative_least_squares(a: np.ndarray, b: np.ndarray, rounds: int) -> np.ndarray:
    """x >= 0 that minimises |a x - b|, by active sets: the column with the steepest gain
    enters, and columns whose coefficient would turn negative leave."""
    x, active = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    scale = max(1.0, float(np.abs(b).max()))
    for _ in range(rounds):
        gain = a.T @ (b - a @ x)
        gain[active] = -np.inf
        best = int(gain.argmax())
        if gain[best] <= 1e-9 * scale:
            break
        active[best] = True
        while True:
            trial, own = np.zeros_like(x), a[:, active]
            square = own.T @ own
            square[np.diag_indices_from(square)] += 1e-9
            trial[active] = np.linalg.solve(square, own.T @ b)
            down = active & (trial <= 0)
            if not down.any():
                break
            step = np.min(x[down] / np.maximum(x[down] - trial[down], 1e-300))
            x += step * (trial - x)
            active &= x > 1e-12 * scale
            x[~active] = 0
            if not active.any():
                return x
        x = trial
    return x


def plan_packing(counts: np.ndarray, depth: int = 3) -> tuple[Plan, np.ndarray]:
    """Repeats of combinations, and how many pieces of each size are left for the stream. counts[b]
    pieces have size b; the window is the last index. Every piece is used once or left."""
    window, left, plan = len(counts) - 1, counts.astype(np.int64).copy(), []
    stream = np.zeros_like(left)
    if left[window]:
        plan.append(((window,), int(left[window])))
        left[window] = 0
    present = np.flatnonzero(left)
    combos = combinations(window, depth, present)
    if combos:
        a = np.zeros((len(present), len(combos)))
        row = {b: i for i, b in enumerate(present.tolist())}
        for j, c in enumerate(combos):
            for b in c:
                a[row[b], j] += 1
        x = nonnegative_least_squares(a, left[present].astype(float), 3 * len(present))
        for j in np.argsort(-x, kind="stable"):
            own, uses = np.unique(combos[j], return_counts=True)
            repeats = int(min(np.floor(x[j] + 1e-6), (left[own] // uses).min()))
            if repeats > 0:
                plan.append((combos[j], repeats))
                left[own] -= uses * repeats
    while left.any():  # each round uses up some size, so there are few
        room, chosen = window, []
        rest = left.copy()
        while (fits := np.flatnonzero(rest[: room + 1])).size:
            most = int(fits[-1])
            times = int(min(rest[most], room // most))
            chosen += [most] * times
            rest[most] -= times
            room -= most * times
        own, uses = np.unique(chosen, return_counts=True)
        if room > window // SLACK:  # nothing complements the largest
            stream[chosen[0]] += left[chosen[0]]
            left[chosen[0]] = 0
            continue
        repeats = int((left[own] // uses).min())
        plan.append((tuple(chosen), repeats))
        left[own] -= uses * repeats
    return plan, stream


def runs_of(plan: Plan) -> np.ndarray:
    """Rows (bin, first rank, first sequence, slot), by bin and rank: pieces of a bin from that
    rank on go, one each, to that slot of the sequences from that one on."""
    rows, used, sequence = [], {}, 0
    for combo, repeats in plan:
        for slot, b in enumerate(combo):
            rows.append((b, used.get(b, 0), sequence, slot))
            used[b] = used.get(b, 0) + repeats
        sequence += repeats
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def cut_pieces(docs: DataFrame, tokenizer: str, window: int, quantum: int, key: str = "doc_id", text: str = "text", end_id: int = 0, with_ids: bool = False, special: bool = False) -> DataFrame:
    """Stored pieces: key, start, length, ids_crc32, doc_tokens, bin (the size as it is counted),
    part and rank (of the piece among those of its bin in the part), and the ids: of pieces that
    may be cut, or of all."""
    dtype = id_type(tokenizer)
    end = np.array([end_id], dtype).tobytes()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType
    arrow_key = rows.limit(0).toArrow().schema.field("key").type

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, seen, part = encoder(tokenizer, dtype, special), np.zeros(window + 1, np.int64), TaskContext.get().partitionId()
        for batch in batches:
            found: list[tuple] = []
            raws: list[bytes | None] = []
            texts = (t for _, own in stretches(batch.column("text"), STRETCH_BYTES) for t in own)
            for i, raw in enumerate(enc.encode(texts)):
                ids = np.frombuffer(raw + end, dtype).astype("<u4")
                for start in range(0, len(ids), window):
                    piece = ids[start : start + window]
                    b = len(piece) if len(piece) <= EXACT else -(-len(piece) // quantum) * quantum
                    found.append((i, start, len(piece), zlib.crc32(piece), len(ids), b, seen[b]))
                    seen[b] += 1
                    raws.append(piece.tobytes() if with_ids or len(piece) < window else None)
            cols = np.array(found, np.int64).reshape(-1, 7).T
            out = {"key": batch.column("key").take(pa.array(cols[0])).cast(arrow_key)}
            out |= dict(zip(("start", "length", "ids_crc32", "doc_tokens", "bin", "rank"), cols[1:], strict=True))
            out["part"] = np.full(cols.shape[1], part, np.int64)
            out["ids"] = pa.array(raws, pa.binary())
            yield pa.RecordBatch.from_pydict(out)
        enc.forget()

    schema = f"key {kind.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long, bin long, rank long, part long, ids binary"
    return materialize(rows.mapInArrow(cut, schema), "pieces")


def pack(docs: DataFrame, tokenizer: str, window: int = 1024, quantum: int = 4, depth: int = 3, with_ids: bool = False, **columns) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    if window % quantum:
        raise ValueError("the window must be a multiple of the quantum")
    pieces = cut_pieces(docs, tokenizer, window, quantum, with_ids=with_ids, **columns)
    held = materialize(pieces.groupBy("part", "bin").count(), "piece-counts")
    counts = np.zeros(window + 1, np.int64)
    for row in held.groupBy("bin").agg(F.sum("count").alias("n")).collect():  # a row per size
        counts[row["bin"]] = row["n"]
    plan, stream = plan_packing(counts, depth)
    before = held.select("part", "bin", (F.sum("count").over(Window.partitionBy("bin").orderBy("part")) - F.col("count")).alias("before"))
    ranked = pieces.join(before, ["part", "bin"]).withColumn("rank", F.col("rank") + F.col("before")).drop("part", "before")
    # Of a size, the pieces from that rank on are in the stream.
    late = {int(b): int(counts[b] - stream[b]) for b in np.flatnonzero(stream)}
    if not late:
        return _planned(ranked, plan, window, with_ids)
    from_ = F.create_map(*(F.lit(v).cast("long") for pair in late.items() for v in pair))[F.col("bin")]
    cut = F.col("rank") >= F.coalesce(from_, F.lit(1 << 62))
    return _planned(ranked.where(~cut), plan, window, with_ids).unionByName(_streamed(ranked.where(cut), sum(r for _, r in plan), window, with_ids))


def _planned(ranked: DataFrame, plan: Plan, window: int, with_ids: bool) -> DataFrame:
    """Pieces at the places that the plan has for their ranks."""
    runs = runs_of(plan)
    edges = np.searchsorted(runs[:, 0], np.arange(window + 2))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins, ranks = batch.column("bin").to_numpy(), batch.column("rank").to_numpy()
            sequence, slot = np.empty(len(bins), np.int64), np.empty(len(bins), np.int64)
            for b in np.unique(bins):
                own, mine = runs[edges[b] : edges[b + 1]], bins == b
                at = np.searchsorted(own[:, 1], ranks[mine], "right") - 1
                sequence[mine], slot[mine] = own[at, 2] + ranks[mine] - own[at, 1], own[at, 3]
            yield batch.append_column("sequence_id", pa.array(sequence)).append_column("slot", pa.array(slot)).drop_columns(["bin", "rank"])

    ranked = ranked if with_ids else ranked.drop("ids")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.drop("bin", "rank").schema) + ", sequence_id long, slot long"
    placed = ranked.mapInArrow(place, schema)
    within = Window.partitionBy("sequence_id").orderBy("slot")
    return placed.withColumn("offset", F.sum("length").over(within) - F.col("length")).drop("slot")


def _streamed(ranked: DataFrame, first: int, window: int, with_ids: bool) -> DataFrame:
    """Pieces end to end in sequences from `first` on, cut where a window ends."""
    bucket = F.col("bin") * (1 << 32) + F.floor(F.col("rank") / 4096)
    laid = prefix_sums(ranked, [], [F.col("rank")], bucket, {"at": F.col("length")}).drop("bin", "rank")
    kinds = {f.name: f.dataType.simpleString() for f in laid.schema}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, out = [], {c: [] for c in ("start", "length", "ids_crc32", "sequence_id", "offset", "ids")}
            spots = zip(*(batch.column(c).to_pylist() for c in ("start", "length", "ids", "at_before")), strict=True)
            for i, (start, length, raw, at) in enumerate(spots):
                done = 0
                while done < length:
                    offset = (at + done) % window
                    n = min(length - done, window - offset)
                    own = raw[4 * done : 4 * (done + n)]
                    rows.append(i)
                    for name, value in (("start", start + done), ("length", n), ("ids_crc32", zlib.crc32(own)), ("sequence_id", first + (at + done) // window), ("offset", offset), ("ids", own)):
                        out[name].append(value)
                    done += n
            kept = batch.select(["key", "doc_tokens"]).take(pa.array(rows, pa.int64()))
            data = {"key": kept.column("key"), "doc_tokens": kept.column("doc_tokens")}
            data |= {c: pa.array(v, pa.binary() if c == "ids" else pa.int64()) for c, v in out.items() if with_ids or c != "ids"}
            yield pa.RecordBatch.from_pydict(data)

    schema = f"key {kinds['key']}, doc_tokens long, start long, length long, ids_crc32 long, sequence_id long, offset long" + ", ids binary" * with_ids
    return laid.mapInArrow(cut, schema)
