"""Vector operators, components, archives, and the pipeline, against brute force."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from millrace.llm import near_vectors, neighbours, queries, warc
from millrace.llm.components import components
from tests.compare import compare, connect

VECTORS = "vec_id long, embedding array<float>, id int, x string, block int, cell int"


def vectors(seed=0, n=300, dim=8):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    x = (centres[rng.integers(0, 12, n)] + 0.25 * rng.normal(size=(n, dim))).astype(np.float32)
    x[10:40] = x[5]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(n, None), (n + 1, [0.0] * dim), (n + 2, [1.0, None] + [0.5] * (dim - 2)), (n + 3, [float("nan")] * dim), (n + 4, [float("inf")] + [1.0] * (dim - 1))]
    rows += [(None, x[5].tolist()), (7, x[7].tolist()), (n + 5, [1.0, 2.0, 3.0]), (n + 6, []), (n + 7, [1.0, 2.0, 3.01]), (n + 8, (x[6] * 3).tolist())]
    return [(i, v, 1, "x", 2, 3) for i, v in rows]


def usable(v):
    return v is not None and all(c is not None and math.isfinite(c) for c in v) and any(v)


@pytest.mark.parametrize("blocks", [(16_384, 2_048), (40, 3)])
def test_neighbours(spark, monkeypatch, blocks):
    monkeypatch.setattr(neighbours, "BLOCK", blocks[0])
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", blocks[1])
    rows = vectors()
    got = neighbours.nearest_neighbours(spark.createDataFrame(rows, VECTORS).repartition(3), F.col("vec_id") % 25 == 0).collect()
    good = {i: np.array(v, float) for i, v, *_ in rows if i is not None and usable(v)}
    hits = total = 0
    for q in [i for i in good if i % 25 == 0]:
        exact = sorted((float(np.sqrt(((v - good[q]) ** 2).sum())), i) for i, v in good.items() if i != q and len(v) == len(good[q]))
        own = sorted((r["rank"], r.vec_id, r.score) for r in got if r.query_id == q)
        assert [r for r, _, _ in own] == list(range(1, min(10, len(exact)) + 1))
        assert [(s, i) for _, i, s in own] == sorted((s, i) for _, i, s in own)
        distance = {i: d for d, i in exact}
        assert all(distance[i] == s for _, i, s in own)
        hits += len({i for _, i, _ in own} & {i for _, i in exact[:10]})
        total += len(own)
    assert total and hits / total >= 0.9
    assert neighbours.nearest_neighbours(spark.createDataFrame([], VECTORS), F.col("vec_id") % 25 == 0).count() == 0


def brute_links(rows):
    good = [(i, np.array(v, float)) for i, v, *_ in rows if i is not None and usable(v)]
    links = []
    for a, (i, u) in enumerate(good):
        for j, v in good[a + 1 :]:
            if len(u) == len(v) and u @ v / (np.linalg.norm(u) * np.linalg.norm(v)) >= 0.95 - 1e-12:
                links.append((i, j))
    return good, links


@pytest.mark.parametrize("block", [8_192, 20])
def test_near_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(near_vectors, "BLOCK", block)
    monkeypatch.setattr(near_vectors, "TILE", 7 if block == 20 else 1_024)
    monkeypatch.setattr(near_vectors, "PAIRS_PER_ROW", 0)
    rows = [r for r in vectors(3) if r[0] != 7 or r is not None]
    rows = [r for i, r in enumerate(rows) if r[0] not in {s[0] for s in rows[:i]} or r[0] is None]
    got = {r.vec_id: r for r in near_vectors.near_duplicates(spark.createDataFrame(rows, VECTORS).repartition(3)).collect() if r.vec_id is not None}
    good, links = brute_links(rows)
    group = {r[0]: r[0] for r in rows if r[0] is not None}
    for _ in range(len(links)):
        moved = [(i, j) for i, j in links if group[i] != group[j]]
        if not moved:
            break
        for i, j in moved:
            group[i] = group[j] = min(group[i], group[j])
    assert set(got) == set(group)
    for i, r in got.items():
        assert (r.n_links, r.component_id, r.kept) == (sum(i in pair for pair in links), group[i], group[i] == i), i
    assert near_vectors.near_duplicates(spark.createDataFrame([], VECTORS)).count() == 0


def test_dense_and_sparse_tiles_agree():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 5)) * 0.05 + np.array([1.0, 1, 0, 0, 0])
    ids, copies = np.arange(600) * 3, rng.integers(1, 4, 600)
    cosine = x @ x.T / np.outer(np.linalg.norm(x, axis=1), np.linalg.norm(x, axis=1))
    linked = (cosine >= 0.99) & ~np.eye(600, dtype=bool)
    links = near_vectors.BlockLinks(x, ids, copies, 0.99)
    links.compare(np.arange(600), np.arange(600), both=False)
    assert (links.degree == linked @ copies).all()
    reach = {int(i): int(i) for i in ids}
    for a, b in links.forest():
        low, high = sorted((reach[a], reach[b]))
        reach = {k: low if v == high else v for k, v in reach.items()}
    label = np.arange(600)
    while True:
        new = np.minimum(label, np.where(linked, label[None, :], 600).min(axis=1))
        if (new == label).all():
            break
        label = new
    assert [reach[int(i)] for i in ids] == (label * 3).tolist()


def test_visits_reach_every_link():
    rng = np.random.default_rng(8)
    x = near_vectors._unit(rng.normal(size=(400, 3)))
    centres = near_vectors.spherical_kmeans(x, 9)
    rows, cells, home = near_vectors.visited_cells(x, centres, 0.95)
    own = {int(r): int(c) for r, c, h in zip(rows, cells, home, strict=True) if h}
    there = {(int(r), int(c)) for r, c in zip(rows, cells, strict=True)}
    for i, j in zip(*np.nonzero(x @ x.T >= 0.95), strict=True):
        low = min(own[i], own[j])
        assert (int(i), low) in there and (int(j), low) in there


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(200, i) for i in range(201, 240)] + [(rng.randint(300, 400), rng.randint(300, 400)) for _ in range(70)] + [(5, 5), (7, 6), (6, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    group = {n: n for e in edges for n in e}
    while any(group[a] != group[b] for a, b in edges):
        for a, b in edges:
            group[a] = group[b] = min(group[a], group[b])
    assert got == {n: g for n, g in group.items() if any(n in e and e[0] != e[1] for e in edges)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


PAGES = "page_id long, url string, html string, key string, refers int"


def pages():
    big = "<p>" + "same é " * 300
    rows = [(1, "http://www.a.example/x?y=1", big), (2, "https://b.example", big), (9, None, big), (3, "not a url", None), (4, "http://a.example/" + "z" * 5000, ""), (5, "http://[bad", "small"), (6, "http://c.example/\r\nX: y", "small"),
            (7, "http://a.example/1", "q" * 1000), (7, "http://a.example/1", "q" * 1000), (8, "http://a.example/1", "w" * 200_000), (None, "http://n.example/", big), (None, "http://n.example/", "r" * 2000), (12, "http://a.example/1", "r" * 999), (13, "http://a.example/2", "r" * 999)]
    return [(*r, "k", 1) for r in rows]


def test_archives(spark):
    df = spark.createDataFrame(pages(), PAGES).repartition(3)
    got = sorted(tuple(r) for r in warc.archive(df).fillna(-1, ["page_id", "refers_to"]).collect())
    want = []
    best = {}
    for p, _, h, *_ in pages():
        if p is not None and len((h or "").encode()) >= 1000:
            best[h] = max(best.get(h, 0), p)
    for p, _, h, *_ in pages():
        raw = (h or "").encode()
        kept = best.get(h) if len(raw) >= 1000 else None
        again = kept is not None and kept != p
        want.append((-1 if p is None else p, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", kept if again else -1))
    assert got == sorted(want)
    assert warc.archive(spark.createDataFrame([], PAGES)).count() == 0


def test_lookup_over_block_borders(spark, tmp_path):
    folder = f"file://{tmp_path}/archives"
    rows = [(i, f"http://h{i % 3}.example/p{i % 7}", f"text {i}", "k", 1) for i in range(200)]
    df = spark.createDataFrame(rows, PAGES).repartition(3)
    captures = warc.write_archives(warc.decide_records(df), folder)
    files = warc.build_capture_index(captures, folder, block_lines=4)
    asked = spark.createDataFrame([("http://h1.example/p1", 1), ("http://h1.example/p1", 22), ("http://h1.example/p1", 5), ("http://zzz.example/", 3), (None, None)], "url string, page long")
    found = warc.lookup(asked, files)
    assert sorted(r.page for r in found.collect()) == [1, 22]
    assert sorted(r.payload.decode() for r in warc.read_records(found, with_payload=True).collect()) == ["text 1", "text 22"]
    assert warc.lookup(df.select("url", F.col("page_id").alias("page")), files).count() == 200


def test_url_keys():
    assert warc.url_key("http://www.A.example:8080/b/c?d=1") == "example,a,www:8080)/b/c?d=1"
    assert warc.url_key(None) == "-" and warc.url_key("https://x.example") == "example,x)/"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, sf, name):
    assert compare(queries.QUERIES[name](spark, sf), queries.SQL[name], connect(sf)) is None


def test_held_out_quality(spark):
    folder = "/root/testdata/sf0.01"
    scored = {r.doc_id: r for r in queries.QUERIES["op4_quality_crf"](spark, folder).collect()}
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    held = [scored[r.doc_id].predicted == r.quality for r in labels if scored[r.doc_id].held_out]
    assert len(held) > 50 and sum(held) / len(held) >= 0.97


def test_pipeline(spark, sf):
    from tests.llm.test_text_operators import brute_groups, brute_repeats

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, schema = docs.columns, docs.schema
    scored = {r.doc_id: r.score for r in queries.QUERIES["op4_quality_crf"](spark, sf).collect()}
    (_, first), (_, second), (_, third), (_, last) = corpus_pipeline.STAGES
    good = first(spark, docs, sf)
    assert good.schema == schema
    rows = {r.doc_id: r for r in good.collect()}
    assert set(rows) == {i for i, s in scored.items() if s >= 0.5} and 0 < len(rows) < docs.count()
    kept = second(spark, good, sf)
    assert kept.columns == columns
    groups = brute_groups([(i, r.text) for i, r in rows.items()])
    stay = {r.doc_id: r for r in kept.collect()}
    assert set(stay) == {g for _, _, g in groups} and all(stay[i] == rows[i] for i in stay)
    cleaned = third(spark, kept, sf)
    assert cleaned.columns == columns and cleaned.schema == schema
    marks = {int(k): (removed, digest) for k, _, removed, _, digest in brute_repeats([(i, r.text) for i, r in stay.items()], 400)}
    after = {r.doc_id: r for r in cleaned.collect()}
    assert set(after) == set(stay)
    for i, r in after.items():
        assert r.n_chars == len(r.text) and r.source == stay[i].source
        assert r.text == stay[i].text if not marks[i][0] else len(r.text.encode()) <= len(stay[i].text.encode()) - marks[i][0]
    packed = last(spark, cleaned, sf)
    assert {r.doc_id for r in packed.collect()} == set(after)
    assert sorted(map(tuple, entry.queries()["pipeline"](spark, sf).select("doc_id", "start", "length", "ids_crc32").collect())) == sorted(map(tuple, packed.select("doc_id", "start", "length", "ids_crc32").collect()))


def test_number_of_cells_follows_the_cost():
    """Vectors in groups get many cells, the given kind some, and no choice moves too many rows."""
    rng = np.random.default_rng(4)
    grouped = np.repeat(rng.normal(size=(64, 64)), 60, axis=0) + 0.05 * rng.normal(size=(3840, 64))
    loose = rng.normal(size=(3000, 64))
    for x, least in ((grouped, 16), (loose, 2)):
        centres = near_vectors.choose_centres(x, 200_000, 0.95)
        rows, _, _ = near_vectors.visited_cells(near_vectors._unit(x), centres, 0.95)
        assert len(centres) >= least and len(rows) <= 1.05 * near_vectors.MOST_COPIES * len(x)
    assert len(near_vectors.choose_centres(loose[:3], 3, 0.95)) == 1
