"""URL lists, embeddings, components and the pipeline."""

import datetime as dt
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tickloom.llm import embdup, quality as scorer, queries, urlfilter
from tickloom.llm.components import components

D = dt.date


def test_url_filter(spark):
    entries = spark.createDataFrame([
        ("spam", "bad.com", "add", D(2024, 1, 5)), ("spam", "bad.com", "remove", D(2024, 1, 10)), ("spam", "bad.com", "add", D(2024, 1, 20)), ("spam", "bad.com", "add", D(2024, 1, 5)),
        ("mal", "x.bad.com", "add", D(2024, 1, 1)), ("mal", "x.bad.com", "remove", D(2024, 1, 1)), ("mal", "ok.org/evil", "add", D(2024, 1, 1)), ("mal", None, "add", D(2024, 1, 1)), ("mal", "ok.org", "add", None),
    ], "list string, key string, action string, day date")
    caps = [(1, "http://bad.com/a", D(2024, 1, 4)), (2, "https://u@X.Bad.com:80/a?b", D(2024, 1, 5)), (3, "http://bad.com", D(2024, 1, 10)), (4, "http://bad.com", D(2024, 1, 25)),
            (5, "http://ok.org/evil/x", D(2024, 2, 1)), (6, "http://ok.org/good", D(2024, 2, 1)), (7, None, D(2024, 2, 1)), (8, "http://bad.com", None), (9, "nothing", D(2024, 1, 6)), (4, "http://bad.com", D(2024, 1, 25)), (10, "http://notbad.com", D(2024, 1, 6))]
    df = spark.createDataFrame(caps, "page_id long, url string, day date").withColumns({"key": F.lit("z"), "list": F.lit("z"), "salt": F.lit(1)})
    got = {r.page_id: (r.blocked, r.lists, r.entry) for r in urlfilter.evaluate(df, entries).collect()}
    assert {k for k, v in got.items() if v[0]} == {2, 4, 5}
    assert got[2] == (True, "spam", "bad.com") and got[5] == (True, "mal", "ok.org/evil") and got[7] == (False, "", None) and len(got) == 10
    assert urlfilter.evaluate(df.where("false"), entries).count() == 0
    assert urlfilter.evaluate(df, entries.where("false")).where("blocked").count() == 0


def test_components(spark):
    rnd = random.Random(3)
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(rnd.randrange(200, 260), rnd.randrange(200, 260)) for _ in range(50)] + [(5, 5), (None, 3), (7, None), (1, 0)]
    parent = {}

    def root(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: root(i) for i in parent}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def tangled(rnd):
    ids = rnd.sample(range(-5000, 5000), 300)
    star = rnd.sample(range(10_000, 20_000), 60)
    return list(zip(ids, ids[1:])) + [(star[0], k) for k in star[1:]] + [(rnd.randrange(30_000, 30_100), rnd.randrange(30_000, 30_100)) for _ in range(60)], min(ids), min(star)


def test_components_of_few_links_take_one_task(spark, monkeypatch):
    """As many rounds over all cores as the longest chain needs took too long where partitions are many."""
    import tickloom.llm.components as module

    tables, real = [], module.stored
    monkeypatch.setattr(module, "stored", lambda df, *a: tables.append(df) or real(df, *a))
    edges, low, middle = tangled(random.Random(4))
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in got if i < 5000} == {low} and {got[i] for i in got if 10_000 <= i < 20_000} == {middle}
    assert len(tables) <= 2


@pytest.mark.parametrize("kind", ["long", "string"])
def test_components_of_links_beyond_a_task(spark, kind):
    edges, *_ = tangled(random.Random(5))
    df = spark.createDataFrame(edges, "a long, b long").select(F.col("a").cast(kind), F.col("b").cast(kind))
    whole = sorted(components(df).collect())
    assert sorted(components(df, part=24).collect()) == whole
    assert len(whole) == len({x for a, b in edges if a != b for x in (a, b)}) and len({r.component for r in whole if int(r.id) < 5000}) == 1


def embeddings(seed=5):
    rnd = np.random.default_rng(seed)
    rows = []
    for label in (0, 1, 1, None):
        for _ in range(6):
            c = rnd.normal(size=16)
            rows += [((c + rnd.normal(size=16) * s).tolist(), label) for s in (0, 0.02, 0.05, 0.08, 0.15)]
    c = rnd.normal(size=16)
    rows += [((c + rnd.normal(size=16) * 0.03).tolist(), 7) for _ in range(90)] + [(c.tolist(), 7)] * 12 + [((c * 2).tolist(), 7)]
    rows += [(None, 0), ([], 0), ([0.0] * 16, 0), ([float("nan")] * 16, 0), ([float("inf")] + [1.0] * 15, 0), ([None] + [1.0] * 15, 0), ([1.0, 0.0], 0), ([1.0, 0.001], 0)]
    return [(i, v, label) for i, (v, label) in enumerate(rows)]


def embedding_brute(rows, threshold=0.98):
    good = [(i, np.array(v, float), y) for i, v, y in rows if v and y is not None and None not in v and np.isfinite(np.array(v, float)).all() and np.any(v)]
    parent, links = {i: i for i, _, _ in rows}, {i: 0 for i, _, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, (i, x, y) in enumerate(good):
        for j, z, w in good[:a]:
            if y == w and len(x) == len(z) and x @ z / np.linalg.norm(x) / np.linalg.norm(z) >= threshold:
                links[i] += 1
                links[j] += 1
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return {i: (links[i], root(i)) for i in parent}


@pytest.mark.parametrize("shard", [4096, 40])
def test_embedding_duplicates(spark, shard):
    rows = embeddings()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    out = embdup.near_duplicates(df.withColumns({c: F.lit(1) for c in ("rep", "v", "id", "mult", "component")}), shard_rows=shard).collect()
    want = embedding_brute(rows)
    assert {r.vec_id: r.component_id for r in out} == {i: c for i, (_, c) in want.items()} and all(r.kept == (r.vec_id == r.component_id) for r in out)
    assert sum(r.n_links for r in out) >= embdup.RECALL * sum(n for n, _ in want.values())
    assert all(r.n_links <= want[r.vec_id][0] for r in out)
    assert embdup.near_duplicates(df.where("false")).count() == 0
    assert embdup.near_duplicates(df.unionByName(df.limit(4))).count() == len(rows)


def test_graph_recall():
    rnd = np.random.default_rng(2)
    c = rnd.normal(size=(60, 24))
    x = np.repeat(c, 40, 0) + rnd.normal(size=(2400, 24)) * 0.08
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph = embdup.SmallWorld.unpack(embdup.SmallWorld(x).pack())
    assert len(graph.links) == 3 and len(graph.top) <= embdup.TOP
    found = {(at + r, n) for at, rows, nodes in embdup.linked(graph, x, np.arange(len(x)), 0.98) for r, n in zip(rows.tolist(), nodes.tolist())}
    want = {tuple(p) for p in np.argwhere(x @ x.T >= 0.98).tolist()}
    assert found <= want and len(found) >= embdup.RECALL * len(want)


def test_small_labels_have_graphs():
    rnd = np.random.default_rng(4)
    x = np.repeat(rnd.normal(size=(20, 16)), 10, 0) + rnd.normal(size=(200, 16)) * 0.05
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph = embdup.SmallWorld(x)
    assert len(graph.links) >= 1 and len(graph.top) <= embdup.TOP
    found = {(at + r, n) for at, rows, nodes in embdup.linked(graph, x, np.arange(200), 0.98) for r, n in zip(rows.tolist(), nodes.tolist())}
    assert found == {tuple(p) for p in np.argwhere(x @ x.T >= 0.98).tolist()}


def test_failed_audits_widen_the_search(monkeypatch):
    rnd = np.random.default_rng(5)
    x = rnd.normal(size=(300, 8))
    x[150:] = x[:150] + rnd.normal(size=(150, 8)) * 0.05
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph = embdup.SmallWorld(x)
    graph.links = [np.full_like(links, -1) for links in graph.links]  # a graph that leads nowhere
    found = {(at + r, n) for at, rows, nodes in embdup.linked(graph, x, np.full(300, -1), 0.98) for r, n in zip(rows.tolist(), nodes.tolist())}
    assert found == {tuple(p) for p in np.argwhere(x @ x.T >= 0.98).tolist()} and len(graph.top) >= 128


def test_cells_keep_all_links(spark):
    """A label of many shards around pivots, one cell of it dense."""
    rnd = np.random.default_rng(6)
    c = rnd.normal(size=(40, 12))
    x = np.concatenate([np.repeat(c, 20, 0) + rnd.normal(size=(800, 12)) * 0.08, c[0] + rnd.normal(size=(300, 12)) * 0.02])
    rows = [(i, v.tolist(), 3) for i, v in enumerate(x)]
    out = embdup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), shard_rows=100).collect()
    want = embedding_brute([(i, np.float32(v).astype(float).tolist(), y) for i, v, y in rows])
    assert {r.vec_id: r.component_id for r in out} == {i: c for i, (_, c) in want.items()}
    assert sum(r.n_links for r in out) >= embdup.RECALL * sum(n for n, _ in want.values()) and all(r.n_links <= want[r.vec_id][0] for r in out)


def test_pipeline(spark, tmp_path):
    rnd = random.Random(6)
    from test_text_operators import decontam_brute, near_brute, prose

    items = [(i, prose(rnd, 30)) for i in range(5)]
    rows, quality = [], []
    for i in range(260):
        t = prose(rnd, rnd.randrange(60, 160))
        if i % 4 == 0:
            t = t.upper().replace(" ", "!! ")
        elif i % 13 == 1:
            t = t + " " + items[i % 5][1]
        elif i % 13 == 2:
            t = rows[-1][1]
        elif i % 13 == 3:
            t += " password = Zq81Kd93mmPa end"
        rows.append((i, t, "en", "s", len(t)))
        quality.append((i, int(i % 4 != 0), 0))
    rows += [(900, None, None, None, None), (901, "", "en", "s", 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for name, data, kind in (("documents", rows, schema), ("labels", quality, "doc_id long, quality int, toxic int"), ("benchmark", items, "item_id long, text string")):
        spark.createDataFrame(data, kind).write.parquet(f"{tmp_path}/{name}.parquet")
    docs = spark.createDataFrame(rows, schema)
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "quality_classifier" and len(corpus_pipeline.STAGES) == 5
    before = {r[0]: r[1] for r in rows}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, str(tmp_path))
        out = docs.collect()
        now = {r.doc_id: r for r in out}
        if k < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        if k == 0:
            good = {i for i, y, _ in quality if y}
            labels = spark.read.parquet(f"{tmp_path}/labels.parquet")
            first = spark.createDataFrame(rows, schema)
            assert set(now) == {r.doc_id for r in scorer.score(first, scorer.fit(first, labels), ["doc_id"]).where("predicted = 1").collect()}
            assert len(good & set(now)) >= 0.95 * len(good) and len(set(now) - good) <= 20
        elif k == 1:
            assert set(now) == {i for i, (_, c) in near_brute(list(before.items())).items() if c == i}
        elif k == 2:
            assert set(now) == {i for i, v in decontam_brute(before.items(), items).items() if not v[4]}
        elif k == 3:
            assert set(now) == set(before)
            for i, r in now.items():
                if before[i] and "password" in before[i]:
                    assert r.text == re.sub("password = Zq81Kd93mmPa", "[SECRET]", before[i]) and r.n_chars == len(r.text)
                else:
                    assert r.text == before[i]
        else:
            import sentencepiece

            sp = sentencepiece.SentencePieceProcessor(model_file=queries.piece_model())
            assert set(now) == set(before) and all(r.ids == sp.encode(before[i] or "", add_bos=True, add_eos=True) for i, r in now.items())
        before = {r.doc_id: getattr(r, "text", None) for r in out}
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == set(before)
