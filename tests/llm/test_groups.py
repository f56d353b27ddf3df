"""Near-duplicate joins and decontamination against brute force."""

import itertools
import random
import re

import numpy as np
import pytest

from marquee.llm import decontaminate, jaccard_join, near_vectors
from marquee.llm.queries import QUERIES
from marquee.llm.shared import components, shingles


def _spread(nodes, links):
    """Smallest member of each node's component."""
    of = {k: k for k in nodes}

    def root(k):
        while of[k] != k:
            k = of[k]
        return k

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        of[b] = a
    return {k: root(k) for k in nodes}


def _sets(rows, size):
    out = []
    for _, text in rows:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
        out.append({tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    return out


def _brute_groups(rows, size, num, den=100):
    sets = _sets(rows, size)
    by_set = {}
    for i, s in enumerate(sets):
        if s:
            by_set.setdefault(frozenset(s), []).append(i)
    links = [(v[0], i) for v in by_set.values() for i in v[1:]]
    for a, b in itertools.combinations(by_set, 2):
        if den * min(len(a), len(b)) >= num * max(len(a), len(b)):
            inter = len(a & b)
            if den * inter >= num * (len(a) + len(b) - inter):
                links.append((by_set[a][0], by_set[b][0]))
    root = _spread(range(len(rows)), links)
    least = {}
    for i, (k, _) in enumerate(rows):
        least[root[i]] = min((x for x in (least.get(root[i]), k) if x is not None), default=None)
    return sorted(((k, len(s), k if not s else least[root[i]]) for i, ((k, _), s) in enumerate(zip(rows, sets))), key=repr)


def _near_copies(seed, groups=40, most=12, shared=0):
    """Documents of many lengths with copies that differ by few words, chains, and shared passages."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(3000)]
    passage = [rng.choice(vocabulary) for _ in range(40)]
    texts = []
    for _ in range(groups):
        text = [rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 4, 8, 12, 20, 30, 50, 90, 150, 400]))]
        if shared and rng.random() < shared:
            text = passage + text
        texts.append(text)
        for _ in range(rng.randint(0, most)):
            text = list(text)
            for _ in range(rng.randint(0, 1 + len(text) // 40)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                text = text[: max(1, len(text) - rng.randint(1, 2))]
            texts.append(text)
    rng.shuffle(texts)
    return [(k, " ".join(t)) for k, t in enumerate(texts, 100)]


@pytest.mark.parametrize("size, similarity", [(3, 0.9), (5, 0.8)])
@pytest.mark.parametrize("seed, shared", [(1, 0), (2, 0.6)])
def test_jaccard_groups_equal_brute_force(docs_of, odd_rows, size, similarity, seed, shared):
    rows = _near_copies(seed, shared=shared) + odd_rows
    got = jaccard_join.jaccard_groups(docs_of(rows), size, similarity).collect()
    assert sorted(map(tuple, got), key=repr) == _brute_groups(rows, size, round(similarity * 100))


def test_one_large_group_of_copies_that_are_no_neighbours_of_one_another(docs_of, monkeypatch):
    """Copies of one text with a word or two changed: most pairs miss the threshold, so the first center settles few."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(500)}" for _ in range(60)]
    rows = []
    for k in range(150):
        text = list(base)
        for _ in range(rng.randint(1, 3)):
            text[rng.randrange(60)] = f"x{rng.randrange(9)}"
        rows.append((k, " ".join(text)))
    monkeypatch.setattr(jaccard_join, "BLOCK", 20)
    got = jaccard_join.jaccard_groups(docs_of(rows), 3, 0.9).collect()
    assert sorted(map(tuple, got), key=repr) == _brute_groups(rows, 3, 90)


def test_jaccard_query(spark, sf_dir, documents):
    got = QUERIES["op2_jaccard_join"](spark, sf_dir).collect()
    assert sorted(map(tuple, got), key=repr) == _brute_groups(documents, 3, 90)


def test_jaccard_of_an_empty_table(docs_of):
    assert jaccard_join.jaccard_groups(docs_of([])).collect() == []


@pytest.mark.parametrize("num", [80, 90])
def test_linked_sets_agree_in_a_segment(num):
    rng = np.random.default_rng(num)
    for n in list(range(1, 60)) + [100, 333, 1000]:
        for _ in range(5):
            a = rng.integers(0, 1 << 63, n).astype(np.uint64)
            drop = rng.integers(0, n * (100 - num) // 100 + 1)
            b = np.unique(np.concatenate([a[drop:], rng.integers(0, 1 << 63, rng.integers(0, 2)).astype(np.uint64)]))
            a = np.unique(a)
            common = len(np.intersect1d(a, b))
            if not len(b) or 100 * common < num * (len(a) + len(b) - common) or np.array_equal(a, b):
                continue
            keys = [set(jaccard_join.segment_keys(x, num, 100).tolist()) for x in (a, b)]
            assert keys[0] & keys[1]
            sketch = jaccard_join._folded([jaccard_join.parity_sketch(x) for x in (a, b)])
            assert np.bitwise_count(sketch[0] ^ sketch[1]).sum() <= len(a) + len(b) - 2 * common


def test_shingles():
    assert len(shingles("a b c a b c", 3)) == 3
    assert len(shingles("A b", 3)) == 1 and np.array_equal(shingles("A b", 3), shingles("a\tB ", 3))
    assert len(shingles(None, 3)) == len(shingles(" \n", 3)) == 0


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_equal_union_find(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(90)] + [(k, k + 1) for k in range(300, 340)] + [(500, k) for k in range(501, 560)]
    want = _spread({x for p in links for x in p}, links)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame([*links, (None, 1)], "a bigint, b bigint")).collect()}
    assert got == {k: v for k, v in want.items() if k != v}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def _brute_vectors(rows, least=0.98):
    usable = []
    for i, (k, x, label) in enumerate(rows):
        x = np.array(x if x and None not in x else [], float)
        usable.append(x if k is not None and label is not None and len(x) and np.isfinite(x).all() and x.any() else None)
    links = [(i, j) for i, j in itertools.combinations(range(len(rows)), 2)
             if usable[i] is not None and usable[j] is not None and rows[i][2] == rows[j][2] and len(usable[i]) == len(usable[j])
             and usable[i] @ usable[j] / (np.linalg.norm(usable[i]) * np.linalg.norm(usable[j])) >= least]
    root = _spread(range(len(rows)), links)
    n = [sum(i in p for p in links) for i in range(len(rows))]
    least_id = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least_id[root[i]] = min(least_id.get(root[i], r[0]), r[0])
    return sorted(((r[0], n[i], least_id.get(root[i]), r[0] == least_id.get(root[i])) for i, r in enumerate(rows)), key=repr)


VECTORS = "vec_id bigint, embedding array<float>, label int, rep int, times int, key int, x int"


def _vector_rows(seed, size=64, groups=30, most=8):
    rng = np.random.default_rng(seed)
    found = []
    for _ in range(groups):
        x = rng.normal(size=size)
        label = int(rng.integers(0, 3))
        for _ in range(rng.integers(1, most)):
            found.append(((x + rng.normal(size=size) * rng.choice([0, 0.05, 0.1, 0.14])).astype(np.float32).tolist(), label))
    return [(k, x, label) for k, (x, label) in enumerate(found, 10)]


ODD_VECTORS = [(1, None, 1), (2, [], 1), (3, [0.0] * 64, 1), (4, [float("nan")] + [1.0] * 63, 1), (5, [None] + [1.0] * 63, 1),
               (6, [1.0] * 64, None), (None, [1.0] * 64, 2), (7, [1.0] * 64, 2), (7, [1.0] * 64, 2), (8, [2.0] * 64, 2), (9, [1.0] * 8, 2)]


@pytest.mark.parametrize("seed, size", [(1, 64), (2, 64), (3, 20)])
def test_near_vectors_equal_brute_force(spark, seed, size):
    rows = _vector_rows(seed, size) + (ODD_VECTORS if size == 64 else [])
    frame = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], VECTORS)
    assert sorted(map(tuple, near_vectors.near_vectors(frame).collect()), key=repr) == _brute_vectors(rows)


def test_a_bucket_of_many_blocks(spark, monkeypatch):
    rows = _vector_rows(4, groups=1, most=2) * 0 + [(k, x, 1) for k, (_, x, _) in enumerate(_vector_rows(6, groups=3, most=60))]
    monkeypatch.setattr(near_vectors, "BLOCK", 7)
    frame = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], VECTORS)
    assert sorted(map(tuple, near_vectors.near_vectors(frame).collect()), key=repr) == _brute_vectors(rows)


def test_near_vectors_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert sorted(map(tuple, QUERIES["op10_near_vectors"](spark, sf_dir).collect()), key=repr) == _brute_vectors(rows)
    assert near_vectors.near_vectors(spark.createDataFrame([], VECTORS)).collect() == []


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(1).normal(size=(5, 16))
    y = near_vectors.hadamard(x)
    assert np.allclose((y * y).sum(axis=1), 16 * (x * x).sum(axis=1)) and np.allclose(near_vectors.hadamard(y), 16 * x)


def _brute_leaks(docs, items, size=5, least=80):
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    cut = lambda t: {tuple(w[i:i + size]) for w in [words(t)] for i in range(len(w) - size + 1)}
    wanted = {}
    for k, t in items:
        if k is not None:
            wanted.setdefault(k, set()).update(cut(t))
    found = {}
    for k, t in docs:
        held = cut(t)
        for i, s in wanted.items():
            n = len(s & held)
            if k is not None and s and 100 * n >= least * len(s):
                found[k, i] = (len(s), max(n, found.get((k, i), (0, 0))[1]))
    # an item of fewer words is one shingle of its own length
    short = {}
    for i, t in items:
        if i is not None and 0 < len(words(t)) < size:
            short.setdefault(i, set()).add(tuple(words(t)))
    for k, t in docs:
        held = words(t)
        runs = {tuple(held[at:at + m]) for m in range(1, size) for at in range(len(held) - m + 1)}
        for i, s in short.items():
            n = len(s & runs)
            if k is not None and 100 * n >= least * len(s):
                old = found.get((k, i), (0, 0))
                found[k, i] = (max(len(s), old[0]), max(n, old[1]))
    return sorted((*k, *v) for k, v in found.items())


def _leaks(frame):
    return sorted((r["doc_id"], r["item_id"], r["n_item"], r["n_shared"]) for r in frame.collect())


def test_decontamination_equals_brute_force(spark, docs_of, odd_rows):
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(400)}"
    items = [(k, " ".join(word() for _ in range(rng.choice([1, 4, 5, 6, 9, 14, 30, 60])))) for k in range(60)]
    items += [(None, "a b c d e f"), (70, None), (71, ""), (72, "a b c d e f"), (72, "a b c d e f"), (73, items[20][1])]
    docs = list(odd_rows)
    for k in range(200):
        text = [word() for _ in range(rng.randint(0, 300))]
        for _, item in rng.sample(items[:60], 2):
            part = item.split()
            for _ in range(rng.randint(0, 2)):
                part[rng.randrange(len(part))] = word()
            at = rng.randint(0, len(text))
            text[at:at] = [x.upper() + "," for x in part] if rng.random() < 0.5 else part
        docs.append((k + 100, " ".join(text)))
    frame = spark.createDataFrame([(*r, 1) for r in items], "item_id bigint, text string, doc_id int")
    assert _leaks(decontaminate.find_items(docs_of(docs), frame)) == _brute_leaks(docs, items)
    assert _leaks(decontaminate.find_items(docs_of([]), frame)) == []
    assert _leaks(decontaminate.find_items(docs_of(docs), frame.limit(0))) == []


def test_decontamination_query(spark, sf_dir, documents):
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    assert _leaks(QUERIES["op1_decontamination"](spark, sf_dir)) == _brute_leaks(documents, items)


def test_short_items_are_found_as_a_whole(docs_of, spark):
    rng = random.Random(4)
    docs = [(k, " ".join(rng.choice(["a", "b", "c", "D!", "e", "中文"]) for _ in range(rng.choice([0, 1, 3, 12])))) for k in range(120)] + [(None, "a b"), (500, None)]
    items = [(1, "a"), (2, "A, b"), (3, "中文"), (4, "b c d e"), (5, "e e e"), (6, ""), (7, None), (8, "a b c d e"), (9, "c a"), (9, "zz"), (None, "a")]
    wanted = _brute_leaks(docs, items)
    found = decontaminate.find_items(docs_of(docs), spark.createDataFrame(items, "item_id int, text string"))
    assert _leaks(found) == wanted and {i for _, i, *_ in wanted} >= {1, 2, 3}
