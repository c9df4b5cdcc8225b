"""N-gram Jaccard join: a size-aware heavy-light join (operator 6).

A document's set is its distinct word n-grams, as 64-bit hashes. Documents with the same set
are one class; classes are joined. All sets share one order of grams: those that are frequent
somewhere last, by the magnitude of their counts, then by hash. If two sets of s and t grams reach the similarity, they share at
least `need(s)` grams, so the first s - need(s) + k grams of each hold k common ones.

Light sets (fewer than `boundary` grams) emit every 2-subset of their first s - need(s) + 2
grams; two light sets that match share a subset. Heavy sets scan the inverted lists of their
first s - need(s) + 1 grams, in which light sets near the boundary stand too. The boundary is
the size with the least total cost: subsets emitted below it, list entries scanned from it on,
taken from the counts of all classes by size.

Two sets that share a list and pass the size, position and miss bounds are a candidate, checked by
parity bits, which refuse no similar pair, and then on the whole sets. *Misses*: of the two
prefixes one ends first, and its grams that are in no list with another set are not in the other
set. So one of the two sets must be able to miss all such grams of its prefix. That keeps apart
long texts that only have a passage in common. Lists are first checked as stars
around their smallest member, then pairs of lists that follow each other in several sets, and the
links found give groups; then all members of a list that are still in different groups and pass
the bounds are checked as pairs. So a
list of n near copies costs n checks and not n * n, and no link between groups is missed.

Defined cases: null, empty and white texts have an empty set, link with nothing, and are their
own component; with fewer than n words the whole sequence is the only gram; rows that repeat a
key are one node; rows without key link with nothing and have no component; an empty table
gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import components
from millrace.llm.words import LOWER, chunks, mixed, stretches, word_hashes
from millrace.session import discard, materialize

# Grams are frequent when `FREQUENT` of the sets of one counted stretch hold them.
STRETCH_SETS = 8_192
STRETCH_BYTES = 500_000
FREQUENT = 4
PARITY_BITS = 2_048
FIRST_LISTS = 12
STAR_CENTRES = 6
_STEP = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(texts: list[str | None], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams of all texts in order, and how many each text has."""
    raws = [(t or "").encode() for t in texts]
    sizes = np.array([len(r) + 1 for r in raws], np.int64)
    data = LOWER[np.frombuffer(b"\n".join(raws) + b"\n", np.uint8)]
    firsts, hashes = [], []
    for at, to in chunks(data):
        starts, own = word_hashes(data[at:to])
        firsts.append(starts + at)
        hashes.append(own)
    first = np.concatenate(firsts) if firsts else np.empty(0, np.int64)
    words = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
    ends = np.cumsum(sizes)
    counts = np.diff(np.searchsorted(first, np.concatenate([[0], ends])))
    # A gram starts at every word with n - 1 more behind it in its text; a short text has one.
    grams = np.maximum(counts - n + 1, np.minimum(counts, 1))
    begin = np.cumsum(counts) - counts
    at = np.repeat(begin - (np.cumsum(grams) - grams), grams) + np.arange(int(grams.sum()))
    length = np.repeat(np.minimum(counts, n), grams)
    sums = mixed(length.astype(np.uint64))
    for k in range(n):
        inside = length > k
        sums[inside] = mixed(sums[inside] * _STEP + words[at[inside] + k])
    return sums, grams


def gram_sets(texts: list[str | None], n: int) -> list[np.ndarray]:
    """Sorted distinct grams of each text."""
    grams, counts = gram_hashes(texts, n)
    return [np.unique(g) for g in np.split(grams, np.cumsum(counts)[:-1])] if texts else []


def need(size: np.ndarray | int, percent: int) -> np.ndarray | int:
    """Grams that a set shares at least with any set it is similar to."""
    return -(-size * percent // 100)


def frequent_grams(rows: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Grams held by `FREQUENT` sets of a counted stretch of `STRETCH_SETS`, sorted, and the
    magnitudes (powers of two) of their counts. A gram in
    `FREQUENT` / `STRETCH_SETS` of all sets reaches that in one stretch at least. They only
    steer the order. Kept are those whose counted total is a quarter of that share of all sets,
    at most 4 * STRETCH_SETS / FREQUENT times the mean set size, whatever the corpus."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sets = [], 0

        def flush() -> pa.RecordBatch:
            grams, times = np.unique(np.concatenate(held), return_counts=True) if held else (np.empty(0, np.uint64), np.empty(0, np.int64))
            often = times >= FREQUENT
            return pa.RecordBatch.from_pydict({"gram": np.concatenate([grams[often], np.zeros(1, np.uint64)]).view(np.int64), "n": np.concatenate([times[often], [0]]).astype(np.int64), "sets": np.array([0] * int(often.sum()) + [sets], np.int64)})

        for batch in batches:
            for _, own in stretches(batch.column("text"), STRETCH_BYTES, STRETCH_SETS):
                held += gram_sets(own, n)
                sets += len(own)
                if sets >= STRETCH_SETS or sum(map(len, held)) > 8_000_000:
                    yield flush()
                    held, sets = [], 0
        if sets:
            yield flush()

    counted = materialize(rows.mapInArrow(count, "gram long, n long, sets long"), "gram-counts")
    sets = counted.agg(F.sum("sets")).first()[0] or 0
    often = counted.where("n > 0").groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") >= max(FREQUENT, sets * FREQUENT / STRETCH_SETS / 4))
    found = often.toArrow()
    discard(counted)
    grams, times = found.column("gram").to_numpy().view(np.uint64), found.column("n").to_numpy()
    order = np.argsort(grams)
    return grams[order], np.log2(times[order]).astype(np.int8)


def ordered(grams: np.ndarray, frequent: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, int]:
    """A sorted set in the common order, and how many of its grams are not frequent."""
    known, magnitude = frequent
    if not len(known):
        return grams, len(grams)
    at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
    late = known[at] == grams
    often = grams[late]
    return np.concatenate([grams[~late], often[np.argsort(magnitude[at[late]], kind="stable")]]), int((~late).sum())


def parity(grams: np.ndarray) -> bytes:
    """For each of so many hash values, whether an odd number of grams has it. Where two sets
    differ in n grams, at most n of these bits differ. The number of bits is a power of two that
    follows the size of the set; halves laid over each other are the parity of half as many."""
    bits = max(PARITY_BITS, 1 << max(0, len(grams) - 1).bit_length())
    return np.packbits(np.bincount((grams % np.uint64(bits)).astype(np.int64), minlength=bits) & 1 > 0).tobytes()


def folded(bits: bytes, size: int) -> np.ndarray:
    """Parity bits as bytes, folded to `size` bytes."""
    out = np.frombuffer(bits, np.uint8)
    while len(out) > size:
        out = out[: len(out) // 2] ^ out[len(out) // 2 :]
    return out


def describe_sets(rows: DataFrame, n: int, percent: int, frequent: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """Stored: key, size, two hashes of the set, its first grams (two more than its prefix),
    how many of these are frequent, and its parity bits."""
    kind = rows.schema["key"].dataType.simpleString()

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, own in stretches(batch.column("text"), STRETCH_BYTES, STRETCH_SETS):
                sizes, digests, heads, late, bits = [], [], [], [], []
                for grams in gram_sets(own, n):
                    line, rare = ordered(grams, frequent)
                    head = line[: len(line) - need(len(line), percent) + 2]
                    sizes.append(len(line))
                    digests.append(hashlib.blake2b(grams.tobytes(), digest_size=16).digest())
                    heads.append(head.tobytes())
                    late.append(max(0, len(head) - rare))
                    bits.append(parity(grams))
                hashes = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_pydict({"key": batch.column("key").slice(at, len(own)), "size": pa.array(sizes, pa.int64()), "h1": hashes[:, 0], "h2": hashes[:, 1], "head": pa.array(heads, pa.binary()), "late": pa.array(late, pa.int64()), "bits": pa.array(bits, pa.binary())})

    return materialize(rows.mapInArrow(describe, f"key {kind}, size long, h1 long, h2 long, head binary, late long, bits binary"), "gram-sets")


def choose_boundary(classes: DataFrame, percent: int, most: int = 64) -> int:
    """The size below which subsets cost less than scans. By size: classes, and frequent grams
    in their prefixes, whose lists are as long as a stretch's threshold at least."""
    held = classes.where(F.col("size").between(2, most)).groupBy("size").agg(F.count(F.lit(1)).alias("n"), F.sum("late").alias("late")).collect()
    cost = np.zeros((2, most + 2))
    for r in held:
        prefix = r["size"] - need(r["size"], percent) + 1
        cost[0, r["size"]] = r["n"] * (prefix + 1) * prefix / 2
        cost[1, r["size"]] = r["n"] * 2 * prefix + r["late"] * FREQUENT
    light = np.concatenate([[0], np.cumsum(cost[0])[:-1]])
    heavy = cost[1].sum() - np.concatenate([[0], np.cumsum(cost[1])[:-1]])
    return int((light + heavy).argmin())


def postings(classes: DataFrame, percent: int, boundary: int) -> DataFrame:
    """List entries: gram (or hash of a 2-subset), node, size, place of the first gram in the
    set's order, and kind: 0 subset, 1 scanned heavy set, 2 light set near the boundary."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, nodes, sizes, places, kinds = [], [], [], [], []
            for node, size, head in zip(*(batch.column(c).to_pylist() for c in ("node", "size", "head")), strict=True):
                grams = np.frombuffer(head, np.uint64)
                prefix = size - need(size, percent) + 1
                if size < boundary:
                    a, b = np.triu_indices(min(prefix + 1, len(grams)), 1)
                    lists.append(mixed(mixed(grams[a]) * _STEP + grams[b]))
                    places.append(a)
                    kinds.append(np.zeros(len(a), np.int8))
                if size >= need(boundary, percent):
                    lists.append(grams[:prefix])
                    places.append(np.arange(prefix))
                    kinds.append(np.full(prefix, 1 if size >= boundary else 2, np.int8))
                count = sum(map(len, lists)) - sum(map(len, nodes))
                nodes.append(np.full(count, node, np.int64))
                sizes.append(np.full(count, size, np.int64))
            if lists:
                yield pa.RecordBatch.from_pydict({"list": np.concatenate(lists).view(np.int64), "node": np.concatenate(nodes), "size": np.concatenate(sizes).astype(np.int32), "place": np.concatenate(places).astype(np.int32), "kind": np.concatenate(kinds).astype(np.int32)})

    return classes.where("size > 1").select("node", "size", "head").mapInArrow(emit, "list long, node long, size int, place int, kind int")


def _bounds(a: str, b: str, percent: int):
    """Whether two entries of a list may be a first meeting of two similar sets."""
    s, t = F.col(f"{a}.size").cast("long"), F.col(f"{b}.size").cast("long")
    overlap = F.ceil((s + t) * percent / (100 + percent) - F.lit(1e-9))
    left = F.least(s - F.col(f"{a}.place"), t - F.col(f"{b}.place"))
    light = F.col(f"{a}.kind") == 0
    some_heavy = light | (F.col(f"{a}.kind") == 1) | (F.col(f"{b}.kind") == 1)
    misses = light | (F.col(f"{a}.alone") <= s - overlap) | (F.col(f"{b}.alone") <= t - overlap)
    return (F.least(s, t) * 100 >= F.greatest(s, t) * percent) & (left >= overlap) & some_heavy & misses


def _likely(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs a, b that their sizes and parity bits allow to be similar: sets of s
    and t grams with c common ones differ in s + t - 2 c, and at most so many bits differ."""
    side = lambda x: classes.select(F.col("node").alias(x), F.col("size").alias(f"s{x}"), F.col("bits").alias(f"b{x}"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s, t = batch.column("sa").to_numpy(), batch.column("sb").to_numpy()
            apart = np.empty(len(s), np.int64)
            for i, (x, y) in enumerate(zip(batch.column("ba").to_pylist(), batch.column("bb").to_pylist(), strict=True)):
                both = min(len(x), len(y))
                apart[i] = np.bitwise_count(folded(x, both) ^ folded(y, both)).sum()
            common = -(-(s + t) * percent // (100 + percent))
            yield batch.select(["a", "b"]).filter(pa.array((apart <= s + t - 2 * common) & (common <= np.minimum(s, t))))

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(check, "a long, b long")


def verify(pairs: DataFrame, rows: DataFrame, classes: DataFrame, n: int, percent: int) -> DataFrame:
    """Those of the pairs a, b whose sets are similar, stored. Sizes and parity bits come first,
    so whole sets are only made and moved for pairs that are similar or nearly so."""
    pairs = materialize(_likely(pairs, classes, percent), "likely-pairs")
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column("node")
            for at, own in stretches(batch.column("text"), STRETCH_BYTES, STRETCH_SETS):
                yield pa.RecordBatch.from_pydict({"node": nodes.slice(at, len(own)), "grams": pa.array([g.tobytes() for g in gram_sets(own, n)], pa.binary())})

    texts = rows.join(wanted, F.col("key") == F.col("node"), "left_semi").select(F.col("key").alias("node"), "text")
    sets = materialize(texts.mapInArrow(gather, "node long, grams binary"), "whole-sets")
    left = sets.select(F.col("node").alias("a"), F.col("grams").alias("ga"))
    right = sets.select(F.col("node").alias("b"), F.col("grams").alias("gb"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same = []
            for x, y in zip(batch.column("ga"), batch.column("gb"), strict=True):
                s, t = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                common = 0
                if len(s) and len(t):
                    common = int((t[np.minimum(np.searchsorted(t, s), len(t) - 1)] == s).sum())
                same.append(common > 0 and 100 * common >= percent * (len(s) + len(t) - common))
            yield batch.select(["a", "b"]).filter(pa.array(same, pa.bool_()))

    met = pairs.join(left, "a").join(right, "b").select("a", "b", "ga", "gb")
    return materialize(met.mapInArrow(check, "a long, b long").distinct(), "gram-links")


def similar_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of `docs`: key, n_shingles, component_id."""
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    described = describe_sets(rows, n, percent, frequent_grams(rows, n))
    # Each set once, under its smallest key: copies meet here and nowhere else.
    classes = described.where("size > 0 and key is not null").groupBy("h1", "h2").agg(F.min("key").alias("node"), F.first("size").alias("size"), F.first("head").alias("head"), F.first("late").alias("late"), F.first("bits").alias("bits"))
    classes = materialize(classes, "gram-classes")
    links = components(_class_links(rows, classes, n, percent))
    named = classes.select(F.col("h1").alias("g1"), F.col("h2").alias("g2"), "node").join(links, "node", "left")
    named = named.select("g1", "g2", F.coalesce("component", "node").alias("component_id"))
    # Rows with an empty set or without key would all meet under one hash: they go by themselves.
    some = described.where("size > 0 and key is not null")
    out = some.join(named, (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2")))
    rest = described.where("not (size > 0 and key is not null)")
    return out.select(F.col("key").alias(key), F.col("size").alias("n_shingles"), "component_id").union(rest.select("key", "size", "key"))


def _open_lists(shared: DataFrame, found: DataFrame) -> DataFrame:
    """Stored: the entries of lists whose members are in several groups, with the member's group
    (component) and the list's largest one (main). Members of a list that are not in its largest
    group meet all members of other groups."""
    grouped = shared.join(components(found), "node", "left").withColumn("component", F.coalesce("component", "node"))
    parts = grouped.groupBy("list", "component").agg(F.count(F.lit(1)).alias("n"))
    most = parts.groupBy("list").agg(F.max(F.struct("n", "component")).alias("most"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    return materialize(grouped.join(most.select("list", F.col("most.component").alias("main")), "list"), "open-lists")


def _class_links(rows: DataFrame, classes: DataFrame, n: int, percent: int) -> DataFrame:
    """Links a, b between classes that connect every group of similar ones."""
    entries = postings(classes, percent, choose_boundary(classes, percent))
    held = entries.groupBy("list").agg(F.collect_list(F.struct("node", "size", "place", "kind")).alias("own")).where(F.size("own") > 1)
    # Lists of the same members say the same: one stays, with each member's first place, which
    # only loosens the position bound.
    members = F.xxhash64(F.transform(F.array_sort("own"), lambda e: F.struct(e["node"], e["kind"])))
    alike = held.select(members.alias("list"), F.explode("own").alias("e")).select("list", "e.*")
    entries_of = alike.groupBy("list", "node", "kind").agg(F.first("size").alias("size"), F.min("place").alias("place"), F.count(F.lit(1)).alias("met"))
    entries_of = materialize(entries_of, "met-grams")
    met = entries_of.where("kind > 0").groupBy(F.col("node").alias("of")).agg(F.sum("met").alias("all"))
    size = F.col("size").cast("long")
    prefix = size - F.ceil(size * percent / 100 - F.lit(1e-9)) + 1
    shared = entries_of.join(met, F.col("node") == F.col("of"), "left").select("list", "node", "kind", "size", "place", (prefix - F.coalesce("all", F.lit(0))).alias("alone"))
    shared = materialize(shared, "shared-grams")
    discard(entries_of)
    first = shared.groupBy("list").agg(F.min(F.struct("node", "size", "place", "kind", "alone")).alias("m")).select("list", "m.*")
    star = shared.alias("x").join(first.alias("y"), F.col("x.list") == F.col("y.list"))
    star = star.where((F.col("x.node") > F.col("y.node")) & _bounds("x", "y", percent))
    star = star.select(F.col("y.node").alias("a"), F.col("x.node").alias("b")).distinct()
    # The smallest centres of a set are enough to find its group; the rest comes with the open lists.
    star = star.groupBy("b").agg(F.slice(F.sort_array(F.collect_list("a")), 1, STAR_CENTRES).alias("own"))
    stars = materialize(star.select(F.explode("own").alias("a"), "b"), "star-pairs")
    found = verify(stars, rows, classes, n, percent)

    # A list's smallest member may be similar to none of a group of near copies in it. These also
    # have most of their lists in common, one behind the other: second stars, around the smallest
    # member of two such lists, link them.
    open_ = _open_lists(shared, found)
    if not open_.isEmpty():
        line = F.sort_array(F.collect_list(F.struct("place", "list")))
        lines = open_.where("kind > 0").groupBy("node").agg(line.alias("line"), F.first("size").alias("size"), F.first("component").alias("component"))
        steps = F.transform(F.slice("line", 1, F.size("line") - 1), lambda e, i: F.xxhash64(e["list"], F.get("line", i + 1)["list"]))
        steps = lines.where(F.size("line") > 1).select("node", "size", "component", F.explode(steps).alias("step"))
        centre = steps.groupBy("step").agg(F.min(F.struct("node", "size", "component")).alias("m")).select("step", "m.*")
        met = steps.alias("x").join(centre.alias("y"), F.col("x.step") == F.col("y.step"))
        fits = F.least("x.size", "y.size").cast("long") * 100 >= F.greatest("x.size", "y.size").cast("long") * percent
        met = met.where(fits & (F.col("x.component") != F.col("y.component"))).select(F.col("y.node").alias("a"), F.col("x.node").alias("b")).distinct()
        met = met.groupBy("b").agg(F.slice(F.sort_array(F.collect_list("a")), 1, STAR_CENTRES).alias("own")).select(F.explode("own").alias("a"), "b")
        second = materialize(met.join(stars, ["a", "b"], "left_anti"), "star-pairs")
        more = verify(second, rows, classes, n, percent)
        stars = stars.union(second)
        if not more.isEmpty():
            found = found.union(more)
            discard(open_)
            open_ = _open_lists(shared, found)

    # Two sets meet in every list they share. Each knows the first open lists of its prefix: where
    # both have one of these before the list at hand, they meet there, under looser bounds.
    firsts = F.slice(F.sort_array(F.collect_list(F.struct("place", "list"))), 1, FIRST_LISTS)
    firsts = open_.where("kind > 0").groupBy(F.col("node").alias("of")).agg(firsts.alias("firsts"))
    before = F.transform(F.filter("firsts", lambda f: f["place"] < F.col("place")), lambda f: f["list"])
    before = F.when(F.col("kind") > 0, F.coalesce(before, F.array().cast("array<long>"))).otherwise(F.array().cast("array<long>"))
    told = open_.join(firsts, F.col("node") == F.col("of"), "left").select("list", "node", "kind", "size", "place", "alone", "component", "main", before.alias("before"))
    told = materialize(told, "open-lists")
    few = told.where("component <> main").alias("x")
    pair = _bounds("x", "y", percent) & (F.col("x.component") != F.col("y.component")) & ~F.arrays_overlap("x.before", "y.before")
    met = few.join(told.alias("y"), F.col("x.list") == F.col("y.list")).where(pair)
    rest = met.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()
    rest = materialize(rest.join(stars, ["a", "b"], "left_anti"), "rest-pairs")
    for table in (shared, open_, told):
        discard(table)
    return found.union(verify(rest, rows, classes, n, percent))
