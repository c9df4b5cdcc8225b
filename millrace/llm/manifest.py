"""Merkle manifest of a table, checked by a recursive climb (operator 13).

*Levels.* A row's leaf is the digest of its fields, made in the scan; texts are never shuffled.
Leaves of a group get their position by bucket totals, so no group is sorted in one task. Every
`FANOUT` consecutive nodes are a run, whose digest is a node one level up; the groups' roots, in
order, are the leaves of the top tree. All runs are stored as node rows: the framed digests of
the run, the run above, and the place in it.

*Climb.* A Spark recursive query starts at the lowest runs and ascends run by run to the root.
The leaves of a run share all siblings above it, so they climb in one row: the siblings are
appended once, and every leaf's own digest, recomputed from its claimed fields, is folded with
them. A framed digest has a fixed width, so folding replaces a stretch of the run's string. What
climbs is raw digests, half as long as their text.
Everything climbs through the root: runs above more than `CLIMBERS` lowest runs are stored several
times, under a salt that deals their climbers evenly.

Defined cases: a null field is `-`; a null group is a group and comes first; null order values
come first in their group, equal ones in the order of their leaves; repeated rows are leaves of
their own; an empty table has no rows. Groups are ordered by the UTF-8 bytes of their text.
Other columns are ignored.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.prefix import id_order_bucket, plain_key, rank_in_group
from millrace.session import materialize

FANOUT = 16
CLIMBERS = 4096
WIDTH = 67  # of a framed digest: "64:" and 64 digits
UNLIMITED = {"spark.sql.cteRecursionRowLimit": "-1"}


def framed(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*values: Column) -> Column:
    return F.sha2(F.concat(*map(framed, values)), 256)


def _framed_run(digests: Column) -> Column:
    return F.array_join(F.transform(digests, lambda d: F.concat(F.lit("64:"), d)), "")


def _framed_bytes(digests: Column) -> Column:
    """Raw digests end to end as framed text."""
    return F.regexp_replace(F.lower(F.hex(digests)), "([0-9a-f]{64})", "64:$1")


def _replaced(run: Column, place: Column, by: Column) -> Column:
    return F.overlay(run, by, place * WIDTH + 1, F.lit(WIDTH))


def _ceil(n: Column, size: int | Column) -> Column:
    return F.floor((n + size - 1) / size).cast("long")


def _above(tree: Column, level: int, pos: Column) -> Column:
    return F.concat(tree, F.lit(f"/{level}/"), F.floor(pos / FANOUT).cast("string"))


def lowest_runs(rows: DataFrame, fields: list[str], group: str, order: str, claimed: dict[str, Column]) -> DataFrame:
    """Stored: g (group), n (its leaves), run, members (place, leaf, claim, id)."""
    claims = digest(*(claimed.get(f, F.col(f)) for f in fields))
    changed = reduce(lambda a, b: a | b, (~c.eqNullSafe(F.col(f)) for f, c in claimed.items()), F.lit(False))
    leaves = rows.select(plain_key(group).alias("g"), F.col(order).alias("id"), digest(*map(F.col, fields)).alias("leaf"), F.when(changed, claims).alias("claim"))
    placed = rank_in_group(leaves, ["g"], [F.col("id").asc_nulls_first(), F.col("leaf")], id_order_bucket(F.col("id"), 4096), "pos")
    member = F.struct((F.col("pos") % FANOUT).cast("int").alias("place"), "leaf", F.coalesce("claim", "leaf").alias("claim"), "id")
    runs = placed.groupBy("g", F.col("pos_total").alias("n"), F.floor(F.col("pos") / FANOUT).alias("run")).agg(F.sort_array(F.collect_list(member)).alias("members"))
    return materialize(runs, "manifest-lowest")


def group_levels(lowest: DataFrame) -> list[DataFrame]:
    """Stored runs by level, from 1 on: g, n, pos, digests (framed), node."""
    named = lambda rows: rows.withColumn("node", F.sha2("digests", 256))
    levels = [materialize(named(lowest.where("n > 1").select("g", "n", F.col("run").alias("pos"), _framed_run(F.col("members.leaf")).alias("digests"))), "manifest-level")]
    most = lowest.agg(F.max("n")).first()[0] or 0
    size = FANOUT
    while size < most:
        children = levels[-1].where(_ceil(F.col("n"), size) > 1)
        runs = children.groupBy("g", "n", F.floor(F.col("pos") / FANOUT).alias("above")).agg(F.sort_array(F.collect_list(F.struct("pos", "node"))).alias("own"))
        levels.append(materialize(named(runs.select("g", "n", F.col("above").alias("pos"), _framed_run(F.col("own.node")).alias("digests"))), "manifest-level"))
        size *= FANOUT
    return levels


def top_levels(groups: DataFrame) -> tuple[list[DataFrame], str]:
    """Stored levels of the top tree, from 0 (groups): pos, node, below (lowest runs), digests (from 1 on); and the root."""
    value = F.when(F.col("g") != "null", F.encode(F.substr("g", F.lit(2)), "UTF-8"))
    bucket = F.conv(F.rpad(F.hex(F.substring(value, 1, 6)), 12, "0"), 16, 10)
    ranked = rank_in_group(groups, [], [F.when(F.col("g") == "null", 0).otherwise(1), F.col("g")], bucket, "pos")
    levels = [materialize(ranked, "manifest-groups")]
    while True:
        last = levels[-1]
        if last.count() == 1:
            return levels, last.first()["node"]
        runs = last.groupBy(F.floor(F.col("pos") / FANOUT).alias("above")).agg(F.sort_array(F.collect_list(F.struct("pos", "node"))).alias("own"), F.sum("below").alias("below"))
        runs = runs.select(F.col("above").alias("pos"), "below", _framed_run(F.col("own.node")).alias("digests"))
        levels.append(materialize(runs.withColumn("node", F.sha2("digests", 256)), "manifest-level"))


def _salts(below: Column) -> Column:
    return _ceil(below, CLIMBERS)


def _linked(level: DataFrame, above: DataFrame | None, number: int) -> DataFrame:
    """Nodes of the top tree with the run above them, their place in it and its salts."""
    if above is None:
        return level.withColumns({"up": F.lit(None).cast("string"), "up_place": F.lit(None).cast("long"), "up_salts": F.lit(1).cast("long")})
    parents = above.select(F.col("pos").alias("parent"), _salts(F.col("below")).alias("up_salts"))
    met = level.withColumn("parent", F.floor(F.col("pos") / FANOUT)).join(parents, "parent").drop("parent")
    return met.withColumns({"up": _above(F.lit("top"), number + 1, F.col("pos")), "up_place": F.col("pos") % FANOUT})


def _group_links(level: DataFrame, number: int, top: DataFrame) -> DataFrame:
    """Runs of groups with the run above them: in the group, or in the top tree, where the run is
    the group's root (`subroot`)."""
    n, size = F.col("n"), FANOUT**number
    inner = level.where(_ceil(n, size) > 1)
    below = F.least(F.lit(size).cast("long"), _ceil(n, FANOUT))
    inner = inner.withColumns({"up": _above(F.col("g"), number + 1, F.col("pos")), "up_place": F.col("pos") % FANOUT, "up_salts": _salts(below), "subroot": F.lit(None).cast("string")})
    links = top.select("g", "up", "up_place", "up_salts")
    return inner.unionByName(level.where(_ceil(n, size) == 1).join(links, "g").withColumn("subroot", F.col("node")))


def climb(lowest: DataFrame, levels: list[DataFrame], tops: list[DataFrame]) -> DataFrame:
    """Stored: g, run, folded (a root for each member), siblings above the run (both raw), subroot."""
    spark = lowest.sparkSession
    linked = [_linked(t, tops[i + 1] if i + 1 < len(tops) else None, i) for i, t in enumerate(tops)]
    kinds = ["name", "digests", "up", "up_place", "up_salts", "subroot", "salts"]
    none = F.lit(None).cast("string")
    runs = [_group_links(level, i, linked[0]).withColumns({"name": F.concat("g", F.lit(f"/{i}/"), F.col("pos").cast("string")), "salts": _salts(F.least(F.lit(FANOUT ** (i - 1)).cast("long"), _ceil(F.col("n"), FANOUT)))}).select(*kinds) for i, level in list(enumerate(levels, 1))[1:]]
    runs += [t.withColumns({"name": F.concat(F.lit(f"top/{i}/"), F.col("pos").cast("string")), "subroot": none, "salts": _salts(F.col("below"))}).select(*kinds) for i, t in list(enumerate(linked))[1:]]
    first = _group_links(levels[0], 1, linked[0]).select("g", F.col("pos").alias("run"), "digests", "up", "up_place", "up_salts", "subroot")
    alone = lowest.where("n = 1").join(linked[0].select("g", "up", "up_place", "up_salts"), "g")

    salt = F.xxhash64("g", "run")
    fold = F.transform("members", lambda m: F.unhex(F.sha2(_replaced(F.col("digests"), m["place"], F.concat(F.lit("64:"), m["claim"])), 256)))
    started = lowest.where("n > 1").select("g", "run", "members").join(first, ["g", "run"]).select("g", "run", fold.alias("folded"), "up", "up_place", "up_salts", "subroot")
    started = started.unionByName(alone.select("g", "run", F.transform("members.claim", F.unhex).alias("folded"), "up", "up_place", "up_salts", F.col("members")[0]["leaf"].alias("subroot")))
    started = started.withColumn("salt", salt).withColumn("at", F.concat("up", F.lit("/"), F.pmod("salt", "up_salts").cast("string")))
    started = materialize(started.select("g", "run", "salt", "folded", F.lit(b"").alias("siblings"), "subroot", "at", F.col("up_place").cast("int").alias("place")), "manifest-start")
    if not runs:
        return started
    nodes = reduce(DataFrame.unionByName, runs).withColumn("own_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)))
    nodes = nodes.select(F.concat("name", F.lit("/"), F.col("own_salt").cast("string")).alias("name"), "digests", "up", F.col("up_place").cast("int").alias("up_place"), "up_salts", F.col("subroot").alias("own_subroot"))
    nodes = materialize(nodes, "manifest-nodes")

    views = {"started": f"started_{uuid.uuid4().hex}", "nodes": f"nodes_{uuid.uuid4().hex}"}
    started.createOrReplaceTempView(views["started"])
    nodes.createOrReplaceTempView(views["nodes"])
    before = {k: spark.conf.get(k, None) for k in UNLIMITED}
    for k, v in UNLIMITED.items():
        spark.conf.set(k, v)
    try:
        risen = spark.sql(f"""
            WITH RECURSIVE rise (g, run, salt, folded, siblings, subroot, at, place) AS (
                SELECT * FROM {views["started"]}
                UNION ALL
                SELECT c.g, c.run, c.salt,
                       transform(c.folded, h -> unhex(sha2(overlay(r.digests PLACING concat('64:', lower(hex(h))) FROM c.place * {WIDTH} + 1 FOR {WIDTH}), 256))),
                       concat(c.siblings, unhex(replace(overlay(r.digests PLACING '' FROM c.place * {WIDTH} + 1 FOR {WIDTH}), '64:', ''))),
                       coalesce(c.subroot, r.own_subroot),
                       concat(r.up, '/', CAST(pmod(c.salt, r.up_salts) AS STRING)), r.up_place
                FROM rise c JOIN {views["nodes"]} r ON c.at = r.name
            )
            SELECT * FROM rise WHERE at IS NULL
        """)
        return materialize(risen, "manifest-climb")
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
        for name in views.values():
            spark.catalog.dropTempView(name)


def manifest(rows: DataFrame, fields: list[str], group: str, order: str, claimed: dict[str, Column] | None = None) -> DataFrame:
    """One row per row: the order column, leaf, subroot, root, proof_sha256, folded_root (from the
    fields as `claimed` has them) and verified."""
    lowest = lowest_runs(rows, fields, group, order, claimed or {})
    levels = group_levels(lowest)
    roots = [level.where(_ceil(F.col("n"), FANOUT**i) == 1).select("g", "n", "node") for i, level in enumerate(levels, 1)]
    alone = lowest.where("n = 1").select("g", "n", F.col("members")[0]["leaf"].alias("node"))
    groups = reduce(DataFrame.union, roots, alone).select("g", "node", _ceil(F.col("n"), FANOUT).alias("below"))
    if groups.isEmpty():
        text = ("leaf", "subroot", "root", "proof_sha256", "folded_root")
        return rows.select(order, *(F.lit("").alias(c) for c in text), F.lit(True).alias("verified")).where(F.lit(False))
    tops, root = top_levels(groups)
    risen = climb(lowest, levels, tops)
    above = risen.select("g", "run", F.transform("folded", lambda h: F.lower(F.hex(h))).alias("folded"), _framed_bytes(F.col("siblings")).alias("siblings"), "subroot")
    own = lowest.select("g", "run", "n", "members").join(above, ["g", "run"])
    run = F.when(F.col("n") > 1, _framed_run(F.col("members.leaf"))).otherwise(F.lit(""))

    def member(m: Column, i: Column) -> Column:
        proof = F.sha2(F.concat(_replaced(F.col("own"), m["place"], F.lit("")), F.col("siblings")), 256)
        folded = F.col("folded")[i]
        return F.struct(
            m["id"].alias(order), m["leaf"].alias("leaf"), F.col("subroot").alias("subroot"), F.lit(root).alias("root"),
            proof.alias("proof_sha256"), folded.alias("folded_root"), (folded == root).alias("verified"),
        )

    return own.withColumn("own", run).select(F.inline(F.transform("members", member)))
