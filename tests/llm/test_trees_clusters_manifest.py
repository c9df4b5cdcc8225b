"""Reply trees, zone-map clusters and the Merkle manifest against brute force."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import manifest as merkle
from millrace.llm import reply_trees, zone_clusters
from millrace.llm.queries import QUERIES
from millrace.session import scratch_path
from tests.llm.cases import SCHEMA, documents, frame

CONTROL = ["", None, "plain", "\\", "\\\\h", "###", "\\###", "####", "</turn>", "</turn>\n", "### user: </turn>\n### assistant: x", "\\h\\t\\c", "a: b", "é😀 日本", "\\### Assistant: </turn> ok", "<\\/turn>", "\n"]
ROLES = ["user", "assistant", "system", None, "", "tool: x", "a</turn>\n", "###", "\\"]


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


# ---------------------------------------------------------------- chat formatting


def escaped(text, role=False):
    out = (text or "").replace("\\", "\\\\").replace("###", "\\h").replace("</turn>", "\\t")
    return out.replace(":", "\\c") if role else out


def conversation(turns):
    """Formatted text, digest columns of a list of (role, text)."""
    whole = "".join(f"### {escaped(r, True)}: {escaped(t)}</turn>\n" for r, t in turns)
    learnt = "".join(t or "" for r, t in turns if r == "assistant")
    return whole, (len(turns), sha("".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)), len(learnt), sha(learnt), len(whole))


def masked(whole, loss):
    """What the run-length mask covers, cut from the whole text by position."""
    at, ends, out = 0, [i + len("</turn>\n") for i in range(len(whole)) if whole.startswith("</turn>\n", i)], []
    for m, end in zip(loss, ends, strict=True):
        out.append(whole[at + m["skip"] : at + m["skip"] + m["length"]])
        at = end
    return out


def test_conversations_as_one_branch(spark, tmp_path):
    rng = random.Random(3)
    rows = [(c, i, rng.choice(ROLES), rng.choice(CONTROL), "x", 1, "k", 2.0) for c in (1, 2, None, 5) for i in range(rng.randint(1, 9))]
    rows += [(9, i, "assistant" if i % 2 else "user", f"{i} " * 40, "x", 1, "k", 2.0) for i in range(530)]
    rows += [(3, 1, "user", "b", "x", 1, "k", 2.0), (3, 1, "user", "a", "x", 1, "k", 2.0), (3, 1, "user", "a", "x", 1, "k", 2.0), (3, None, "assistant", "first", "x", 1, "k", 2.0)]
    rows += [(4, 0, "assistant", "\\### Assistant: </turn> ok" * 50_000, "x", 1, "k", 2.0)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, tree string, node int, t string, leaf double").repartition(3).write.parquet(f"file://{tmp_path}/conversations.parquet")
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.formatted_chars) for r in QUERIES["op11_reply_trees"](spark, f"file://{tmp_path}").collect()}
    turns = {}
    for c, i, role, text, *_ in sorted(rows, key=lambda r: (str(r[0]), -1 if r[1] is None else r[1], r[2] is not None, r[2] or "", r[3] is not None, (r[3] or "").encode())):
        turns.setdefault(c, []).append((role, text))
    turns[-7] = [("user", "\\### Assistant: </turn> ok"), ("assistant", "\\### Assistant: </turn> ok")]
    assert got == {c: conversation(t)[1] for c, t in turns.items()}


def test_empty_conversations(spark, tmp_path):
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"file://{tmp_path}/conversations.parquet")
    assert [r.conv_id for r in QUERIES["op11_reply_trees"](spark, f"file://{tmp_path}").collect()] == [-7]
    none = spark.createDataFrame([], "tree long, node long, parent long, role string, text string, score double")
    assert reply_trees.format_trees(none).count() == 0


def brute_branches(rows, keep):
    """(tree, rank) -> score and messages of the kept branches."""
    own = {}
    for t, n, p, r, x, s in sorted(rows, key=lambda r: (r[2] is not None, r[2] or 0, r[3] is not None, r[3] or "", r[4] is not None, r[4] or "")):
        own.setdefault((t, n), (p, r, x, 0.0 if s is None or math.isnan(s) else s))
    answered = {(t, own[(t, n)][0]) for t, n in own}
    trees = {}
    for t, n in own:
        if n is not None and (t, n) in answered:
            continue
        path, at, seen, ring = [], n, set(), False
        while True:
            seen.add(at)
            path.append(own[(t, at)])
            at = own[(t, at)][0]
            ring = at is not None and at in seen
            if ring or at is None or (t, at) not in own:
                break
        if ring:
            continue
        name = "null" if n is None else f"={n}"
        trees.setdefault(t, []).append((-sum(m[3] for m in path) / len(path), -len(path), name, path[::-1]))
    return {(t, i + 1): (-b[0], [(m[1], m[2]) for m in b[3]]) for t, all_ in trees.items() for i, b in enumerate(sorted(all_, key=lambda b: b[:3])[:keep])}


@pytest.mark.parametrize("keep", [1, 3, 1000])
def test_branches_of_trees(spark, keep):
    rng = random.Random(7)
    rows = []
    for t in (1, 2, 3, None):
        size = {1: 120, 2: 40, 3: 1, None: 25}[t]
        for n in range(size):
            parent = None if n == 0 else rng.choice([rng.randrange(n), n - 1, 0, None if n % 9 == 0 else n - 1])
            rows.append((t, n, parent, rng.choice(ROLES), rng.choice(CONTROL), rng.choice([0.5, 1.0, -2.0, None, float("nan")])))
    rows += [(4, i, i - 1 if i else None, "assistant", f"deep {i}", 1.0) for i in range(300)]
    rows += [(5, 0, None, "user", "hub", 0.0)] + [(5, i, 0, "assistant", f"reply {i}", float(i % 7)) for i in range(1, 400)]
    rows += [(6, 0, 2, "user", "ring", 9.0), (6, 1, 0, "user", "ring", 9.0), (6, 2, 1, "user", "ring", 9.0), (6, 3, 2, "user", "on it", 9.0), (6, 4, 99, "user", "lost parent", 1.0), (6, 5, 5, "user", "own parent", 1.0)]
    rows += [(7, 1, None, "user", "b", 1.0), (7, 1, None, "user", "a", 1.0), (7, 1, None, "user", "a", 1.0), (7, None, 1, "assistant", "no id", 2.0)]
    frame_ = spark.createDataFrame([(*r, "x", 1) for r in rows], "tree long, node long, parent long, role string, text string, score double, t string, leaf int").repartition(5)
    out = reply_trees.format_trees(frame_, keep=keep).collect()
    want = brute_branches(rows, keep)
    assert {(r["tree"], r["rank"]): r.formatted for r in out} == {k: conversation(turns)[0] for k, (_, turns) in want.items()}
    for r in out:
        score, turns = want[(r["tree"], r["rank"])]
        assert math.isclose(r.branch_score, score, abs_tol=1e-9)
        assert masked(r.formatted, r.loss) == [escaped(t) if role == "assistant" else "" for role, t in turns]


def test_no_python_in_the_plan(spark, sf):
    plan = QUERIES["op11_reply_trees"](spark, sf)._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))


# ---------------------------------------------------------------- clusters


def test_hilbert_neighbours():
    """Cells that follow each other on the curve touch, and every cell has a key of its own."""
    for dim, bits in ((2, 3), (3, 2), (4, 2), (2, 1)):
        axes = np.meshgrid(*[np.arange(1 << bits)] * dim, indexing="ij")
        cells = np.stack([a.ravel() for a in axes], axis=1)
        keys = [k.tobytes() for k in zone_clusters.hilbert_keys(cells, bits)]
        assert len(set(keys)) == len(cells)
        walk = cells[sorted(range(len(cells)), key=keys.__getitem__)].astype(int)
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_candidates_hold_the_nearest():
    rng = np.random.default_rng(5)
    dropped = 0
    for _ in range(60):
        centroids = rng.integers(-50, 50, (9, 5))
        x = rng.integers(-50, 50, 5) + rng.integers(-6, 6, (30, 5))
        some = zone_clusters.candidates(x.min(axis=0), x.max(axis=0), centroids)
        dropped += 9 - len(some)
        apart = ((x[:, None] - centroids[None]) ** 2).sum(axis=2)
        assert set(np.flatnonzero((apart == apart.min(axis=1)[:, None]).any(axis=0))) <= set(some)
        for largest in (60, 1 << 40):
            assert (zone_clusters.squared_distances(x, centroids, largest) == apart).all()
    assert dropped > 100


def brute_clusters(rows, clusters, rounds, dim):
    kept = []
    for i, v, *_ in rows:
        if v is not None and len(v) == dim and all(c is not None and math.isfinite(c) for c in v):
            kept.append((i, [math.floor(1024 * c) for c in v], v))
    order = sorted(kept, key=lambda r: (r[0] is None, sha(f"3:{r[0]}") if r[0] is not None else "", r[2]))
    centroids = [r[1] for r in order[:clusters]]

    def near(x):
        apart = [sum((a - b) ** 2 for a, b in zip(x, c, strict=True)) for c in centroids]
        return min(range(len(apart)), key=lambda c: (apart[c], c)), min(apart)

    for _ in range(rounds):
        own = [near(x)[0] for _, x, _ in kept]
        for c in range(len(centroids)):
            mine = [x for (_, x, _), o in zip(kept, own, strict=True) if o == c]
            if mine:
                centroids[c] = [sum(col) // len(mine) for col in zip(*mine, strict=True)]
    placed = [(i, *near(x)) for i, x, _ in kept]
    whole = sum(d for *_, d in placed)
    return sorted(((i, c, d, sum(e for _, o, e in placed if o == c), whole, sha(",".join(map(str, centroids[c])))) for i, c, d in placed), key=repr)


@pytest.mark.parametrize("block, n, spread", [(128, 400, 1.0), (7, 400, 0.05), (128, 3, 1.0), (5, 60, 90_000.0)])
def test_clusters(spark, monkeypatch, block, n, spread):
    monkeypatch.setattr(zone_clusters, "BLOCK", block)
    rng, dim = np.random.default_rng(n), 8
    x = (rng.normal(size=(6, dim))[rng.integers(0, 6, n)] + spread * rng.uniform(-1, 1, size=(n, dim))).astype(np.float32)
    x[n // 2 : n // 2 + n // 3] = x[0]  # a hot vector
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    if n > 3:
        rows += [(n, None), (n + 1, [1.0] * (dim - 1)), (n + 2, [None] + [1.0] * (dim - 1)), (n + 3, [float("nan")] * dim), (n + 4, [float("inf")] * dim), (n + 5, [])]
        rows += [(5, x[5].tolist()), (5, x[6].tolist()), (None, x[7].tolist()), (n + 6, [0.0] * dim), (n + 7, [-0.0009] * dim)]
    frame_ = spark.createDataFrame([(*r, 3, "c", 1.0) for r in rows], "vec_id long, embedding array<float>, cluster int, x string, distance double").repartition(3)
    got = zone_clusters.cluster_vectors(frame_, clusters=5, rounds=6, dim=dim)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_clusters(rows, 5, 6, dim)


def test_clusters_of_nothing(spark):
    for rows in ([], [(1, None), (2, [1.0])]):
        assert zone_clusters.cluster_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).count() == 0


def test_zone_maps_prune(spark):
    """On vectors in groups, most blocks have fewer candidates than there are centroids."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(8, 64))
    x = np.repeat(centres, 500, axis=0) + 0.05 * rng.normal(size=(4000, 64))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, x array<double>")
    blocks = zone_clusters.zone_maps(rows, 64, 1024).collect()
    whole = np.floor(1024 * centres).astype(np.int64)
    some = [len(zone_clusters.candidates(*(np.frombuffer(b[c], np.int32).astype(np.int64) for c in ("low", "high")), whole)) for b in blocks]
    assert sum(len(b["ids"]) for b in blocks) == 4000 and np.mean(some) < 4


# ---------------------------------------------------------------- manifest


def h(*values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def brute_manifest(rows, fanout):
    """Rows of the query from (doc_id, source, lang, n_chars, text)."""

    def climb(nodes, of):
        """The root of nodes; of[i] gets its siblings, from low to high."""
        groups = [[i] for i in range(len(nodes))]
        while len(nodes) > 1:
            runs = [range(a, min(a + fanout, len(nodes))) for a in range(0, len(nodes), fanout)]
            for run in runs:
                for j in run:
                    for i in groups[j]:
                        of[i].append((j - run[0], [nodes[k] for k in run]))
            groups = [[i for j in run for i in groups[j]] for run in runs]
            nodes = [h(*(nodes[j] for j in run)) for run in runs]
        return nodes[0]

    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    trees = {}
    for r in rows:
        bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
        claim = h(*r[:4], r[4].translate(lower)) if bad and r[4] is not None else h(*r)
        trees.setdefault(r[1], []).append((r[0], h(*r), claim))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    paths, subroots = {}, []
    for s in names:
        trees[s].sort(key=lambda m: (m[0] is not None, m[0] or 0, m[1]))
        paths[s] = [[] for _ in trees[s]]
        subroots.append(climb([m[1] for m in trees[s]], paths[s]))
    above = [[] for _ in names]
    root = climb(subroots, above)
    out = []
    for s, subroot, upper in zip(names, subroots, above, strict=True):
        for (i, leaf, claim), path in zip(trees[s], paths[s], strict=True):
            siblings, folded = [], claim
            for place, run in path + upper:
                siblings += run[:place] + run[place + 1 :]
                folded = h(*run[:place], folded, *run[place + 1 :])
            out.append((i, leaf, subroot, root, h(*siblings), folded, folded == root))
    return sorted(out, key=repr)


def awkward_rows():
    rng = random.Random(2)
    rows = [(d[0], rng.choice(["a", "b", None, "", "é"]), rng.choice(["en", None]), rng.choice([1, None]), d[1]) for d in documents()]
    rows += [(1000 + i, rng.choice(["hot", "hot", "a", f"only {i}"]), "en", i, f"Text {i} WITH Capitals") for i in range(400)]
    rows += [(1000, "hot", "en", 0, "same id"), (1001, "hot", "en", 1, "X" * 2_000_000), (None, "hot", None, None, None), (None, "hot", None, None, None)]
    return rows


@pytest.mark.parametrize("fanout, climbers", [(16, 4096), (3, 2), (2, 1)])
def test_manifest(spark, monkeypatch, fanout, climbers):
    monkeypatch.setattr(merkle, "FANOUT", fanout)
    monkeypatch.setattr(merkle, "CLIMBERS", climbers)
    rows = awkward_rows()
    path = scratch_path(spark, "manifest-test")
    spark.createDataFrame([(*r, "x", 1, 2, "g", "n") for r in rows], "doc_id long, source string, lang string, n_chars long, text string, run string, pos int, node int, g string, members string").repartition(4).write.parquet(f"{path}/documents.parquet")
    got = QUERIES["op13_merkle_manifest"](spark, path)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = sorted((tuple(r) for r in got.collect()), key=repr)
    assert got == brute_manifest(rows, fanout)
    assert 0 < sum(not r[-1] for r in got) < len(got) / 3
    assert spark.conf.get("spark.sql.cteRecursionRowLimit", "1000000") != "-1"


@pytest.mark.parametrize("rows", [[], [(1, "a", None, None, "T")], [(1, "a", "l", 3, None), (2, "b", "l", 3, "x")], [(i, "a", "l", 3, str(i)) for i in range(16)], [(i, "a", "l", 3, str(i)) for i in range(17)]])
def test_small_manifests(spark, rows):
    path = scratch_path(spark, "manifest-test")
    spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").write.parquet(f"{path}/documents.parquet")
    got = QUERIES["op13_merkle_manifest"](spark, path).collect()
    assert sorted((tuple(r) for r in got), key=repr) == (brute_manifest(rows, 16) if rows else [])


def test_other_fields_and_groups(spark):
    rows = frame(spark).select("doc_id", "row", F.col("part").alias("shelf"), "text")
    got = merkle.manifest(rows, ["row", "text"], "shelf", "doc_id")
    assert got.count() == len(documents()) and got.where("not verified").count() == 0
    assert "key" in SCHEMA and got.select("root").distinct().count() == 1
