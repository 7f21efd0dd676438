"""Exact and near duplicates, of texts and of vectors, against plain comparison of all pairs."""

from __future__ import annotations

import random
import re
from collections import defaultdict
from hashlib import sha256

import numpy as np
import pytest

from legalops.llm import embedding_dedup, exact_dedup, minhash
from legalops.llm.components import connected_components

SCHEMA = "doc_id long, text string, part int, key string, root int"


def _frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, 1, "x", 2) for i, t in rows], SCHEMA).repartition(parts)


def _components(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def test_components_of_paths_stars_and_cycles(spark):
    rng = random.Random(2)
    links = [(k, k + 1) for k in range(60)] + [(200, 200 + k) for k in range(1, 40)] + [(300, 301), (301, 302), (302, 300)]
    links += [(rng.randrange(400, 450), rng.randrange(400, 450)) for _ in range(30)] + [(7, 7)]
    df = spark.createDataFrame(links, "hi long, lo long")
    found = {r["node"]: r["root"] for r in connected_components(df).collect()}
    linked = {n for a, b in links if a != b for n in (a, b)}
    assert found == _components(linked, links)
    assert connected_components(df.where("false")).collect() == []


def test_exact_duplicates(spark):
    rng = random.Random(1)
    pool = ["", " ", "a b", "a  b", "a\tb", "A b", "long " * 4000, "long " * 3999 + "short ", "é", "x" * 30 + "1", "x" * 30 + "2"]
    rows = [(i, rng.choice(pool)) for i in range(400)] + [(1000 + i, "hot") for i in range(600)] + [(2000, None), (None, "hot"), (None, "solo"), (None, "solo")]
    df = _frame(spark, rows)
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = defaultdict(list)
    for i, t in rows:
        groups[norm(t)].append(i)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # so that small partitions stay apart
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        found = exact_dedup.exact_duplicates(df).collect()
        kept = exact_dedup.drop_exact_duplicates(df).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    text_of = {sha256(norm(t).encode()).hexdigest(): norm(t) for _, t in rows}
    assert len(found) == len(rows)
    for r in found:
        ids = groups[text_of[r["text_sha256"]]]
        known = [i for i in ids if i is not None]
        assert (r["keep_id"], r["group_size"]) == (min(known) if known else None, len(ids))
    for want, of in ((found, lambda r: r["text_sha256"]), ):
        assert sorted(of(r) for r in want if r["kept"]) == sorted(text_of)
    assert sorted(norm(r["text"]) for r in kept) == sorted(groups)
    assert kept[0].asDict().keys() == {"doc_id", "text", "part", "key", "root"}
    assert {r["doc_id"] for r in kept if norm(r["text"]) == "hot"} == {1000}
    assert exact_dedup.exact_duplicates(df.where("false")).collect() == []


def _sets(text, words):
    w = (text or "").encode().lower().split()
    return frozenset([tuple(w)] if 0 < len(w) < words else [tuple(w[k : k + words]) for k in range(len(w) - words + 1)])


def _near_rows():
    rng = random.Random(3)
    words = [f"w{k}" for k in range(500)]
    rows, base = [], [rng.choices(words, k=80) for _ in range(12)]
    for i in range(260):
        text = list(rng.choice(base))
        for _ in range(rng.choice([0, 1, 1, 2, 3, 4, 8])):
            text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((i, " ".join(text).upper() if i % 7 == 0 else "  ".join(text)))
    rows += [(300, None), (301, ""), (302, " \n"), (303, "one two"), (304, "One  TWO"), (305, "two one"), (306, "Ä one two"), (307, "ä one two")]
    return rows + rows[:2] + [(None, "only copy of this text here today"), (None, rows[0][1])]


def test_near_duplicates_equal_all_pairs(spark, monkeypatch):
    rows = _near_rows()
    ids = [i for i, _ in rows if i is not None]
    for words, blocks in ((4, 2048), (5, 40)):
        monkeypatch.setattr(minhash, "BLOCK_DOCS", blocks)
        sets = {i: _sets(t, words) for i, t in rows if i is not None}
        keys = sorted(sets)
        links = [
            (a, b) for n, a in enumerate(keys) for b in keys[n + 1 :]
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
        ]
        want = _components(keys, links)
        found = minhash.near_duplicates(_frame(spark, rows), words=words).collect()
        assert len(found) == len(rows)
        for r in found:
            if r["doc_id"] is not None:
                i = r["doc_id"]
                assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(sets[i]), want[i], want[i] == i)
        assert sorted((r["component_id"], r["kept"]) for r in found if r["doc_id"] is None and r["component_id"] is None) == [(None, True)]
        assert [r["component_id"] for r in found if r["doc_id"] is None and r["component_id"] is not None] == [want[0]]
        assert len(set(ids)) == len(keys)


def test_near_duplicates_are_dropped_with_columns_kept(spark):
    rows = _near_rows()
    kept = minhash.drop_near_duplicates(_frame(spark, rows)).collect()
    want = {r["doc_id"] for r in minhash.near_duplicates(_frame(spark, rows), words=5).collect() if r["kept"]}
    assert {r["doc_id"] for r in kept} == want
    assert kept[0].asDict().keys() == {"doc_id", "text", "part", "key", "root"}
    assert minhash.near_duplicates(_frame(spark, []), words=4).collect() == []


def test_estimate_is_close_to_the_similarity():
    rng = np.random.default_rng(0)
    pool = rng.integers(1 << 63, size=3000, dtype=np.uint64)
    a, b = minhash.signature(np.unique(pool[:2400])), minhash.signature(np.unique(pool[600:]))
    both = ((a > 0) | (b > 0)).sum()
    assert abs(((a == b) & (a > 0)).sum() / both - 0.6) < 0.15


def test_vectors_equal_all_pairs(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = []
    centres = rng.standard_normal((8, 64))
    for i in range(240):
        v = centres[i % 8] + rng.standard_normal(64) * rng.choice([0.02, 0.1, 0.14, 0.2])
        rows.append((i, [float(x) for x in v.astype(np.float32)], int(i % 3)))
    rows += [(500 + k, rows[0][1], 0) for k in range(40)]
    bad = [None, [], [0.0] * 64, [None] + [1.0] * 63, [float("nan")] * 64, [float("inf")] + [1.0] * 63]
    rows += [(700 + k, v, 0) for k, v in enumerate(bad)] + [(800, rows[1][1], None), (801, [1.0, 2.0], 0), (802, [2.0, 4.0], 0), (803, [1.0], 0), (None, rows[0][1], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    good = [(i, np.array(v, float), l) for i, v, l in rows if l is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = defaultdict(set)
    for n, (i, v, l) in enumerate(good):
        for j, w, m in good[n + 1 :]:
            if l == m and len(v) == len(w) and v @ w / (np.sqrt(v @ v) * np.sqrt(w @ w)) >= 0.98:
                links[i].add(j)
                links[j].add(i)
    ids = [i for i, _, _ in rows if i is not None]
    want = _components(ids, [(a, b) for a in links for b in links[a] if a is not None and b is not None])
    for chunk in (1024, 20):
        monkeypatch.setattr(embedding_dedup, "CHUNK", chunk)
        found = {r["vec_id"]: r for r in embedding_dedup.near_duplicate_vectors(df).collect()}
        assert len(found) == len(rows)
        for i in ids:
            assert (found[i]["n_links"], found[i]["component_id"], found[i]["kept"]) == (len(links[i]), want[i], want[i] == i)
        assert (found[None]["component_id"], found[None]["kept"]) == (0, False)
    assert embedding_dedup.near_duplicate_vectors(df.where("false")).collect() == []


def _pairs_at(rng, n, cosine=0.98, dim=64):
    a, b = (rng.standard_normal((n, dim)) for _ in range(2))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(1, keepdims=True) * a
    return a, cosine * a + (1 - cosine**2) ** 0.5 * b / np.linalg.norm(b, axis=1, keepdims=True)


@pytest.mark.parametrize("codes, n", [(64, 4000), (256, 20_000), (1024, 8000), (4096, 4000)])
def test_vectors_at_the_least_cosine_share_a_filter(codes, n):
    filters, rng, missed, far = embedding_dedup.Filters(64, codes), np.random.default_rng(1), 0, 0
    for _ in range(n // 1000):
        a, b = _pairs_at(rng, 1000)
        missed += sum(not np.intersect1d(x, y).size for x, y in zip(filters.lists(a), filters.lists(b)))
        far += int((np.bitwise_count((filters.signs(a) ^ filters.signs(b)).view(np.uint64)) > embedding_dedup.MOST_SIGNS).sum())
    assert (missed, far) == (0, 0)


def test_comparisons_of_a_vector_stay_as_many_as_vectors_grow():
    rng, per_vector = np.random.default_rng(2), []
    for n in (2000, 8000, 32_000):
        filters = embedding_dedup.Filters(64, embedding_dedup.codes_for(n))
        x = rng.standard_normal((n, 64))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        held = np.unique(filters.lists(x).ravel(), return_counts=True)[1].astype(float)
        per_vector.append((held * (held - 1)).sum() / n)
    assert max(per_vector) < 2 * min(per_vector)
    # A list has the filters with the highest sums.
    filters = embedding_dedup.Filters(9, 32)
    unit = x[:20, :9] / np.linalg.norm(x[:20, :9], axis=1, keepdims=True)
    turned = unit @ filters.rotation
    sums = (turned[:, :4] @ filters.codes[0].T)[:, :, None] + (turned[:, 4:] @ filters.codes[1].T)[:, None, :]
    want = np.sort(np.argsort(-sums.reshape(20, -1), axis=1)[:, :40], axis=1)
    assert (filters.lists(unit) == want).all()
