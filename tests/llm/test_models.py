"""Language model, classifiers, licences and the pipeline."""

import math
import os
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from marquee.llm import class_lm, jaccard_join, licenses, quality, toxicity
from marquee.llm.queries import QUERIES
from marquee.llm.shared import HASHES, remainder


def _fold(k, by):
    return zlib.crc32(("" if k is None else str(k)).encode()) % by


def _base(rows):
    tokens = lambda t: [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if x] + [None]
    train = Counter(w for k, t in rows if _fold(k, 10) for w in tokens(t))
    n, v = train.total(), len(train)
    out = []
    for k, t in rows:
        found = tokens(t)
        score = sum(math.log10((train[w] + 0.1) / (n + 0.1 * (v + 1))) for w in found)
        out.append((repr(k), not _fold(k, 10), len(found), sum(w in train for w in found), n, round(score, 6)))
    return sorted(out)


def _scored(frame):
    return sorted((repr(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6))
                  for r in frame.collect())


def test_base_scores_equal_brute_force(docs_of, odd_rows, documents):
    rows = odd_rows + [(k + 100, t) for k, t in documents]
    small = class_lm.Sizes(classes=8, first=40, frequent=300)
    got = class_lm.score_texts(docs_of(rows), remainder(F.col("doc_id"), 10) == 0, small)
    assert _scored(got) == _base(rows)
    assert class_lm.score_texts(docs_of([]), F.lit(False)).collect() == []


def test_without_training_texts(docs_of):
    got = class_lm.score_texts(docs_of([(1, "a b")]), F.lit(True)).collect()
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"]) for r in got] == [(3, 0, 0)] and math.isfinite(got[0]["score"])


def test_classes_beat_unigrams_on_held_out_texts(spark, sf_dir, documents):
    rows = QUERIES["op3_class_lm"](spark, sf_dir).collect()
    assert _scored(spark.createDataFrame(rows)) == _base(documents)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def _brute_class_scores(rows, sizes, smoothing=0.1):
    """Scores of the class model, text by text and word by word."""
    texts = [(not _fold(k, 10), (t or "").lower().encode().split()) for k, t in rows]
    train = [t for held, t in texts if not held]
    counts = Counter(w for t in train for w in t)
    level = {w: math.floor(math.log2(c) * 16) for w, c in counts.items()}
    per_level = Counter(level.values())
    frequent, taken = [], 0
    for at in sorted(per_level, reverse=True):
        taken += per_level[at]
        if taken > sizes.frequent:
            break
        frequent += [w for w in counts if level[w] == at]
    frequent.sort(key=lambda w: (-counts[w], w))
    classes, first = sizes.number(len(counts)), min(sizes.first, len(frequent))
    index = {w: k for k, w in enumerate(frequent)}
    pairs = Counter(p for t in train for p in zip(t, t[1:]))
    seed = np.zeros((first, first))
    for (a, b), n in pairs.items():
        if index.get(a, first) < first and index.get(b, first) < first:
            seed[index[a], index[b]] = n
    start = class_lm.exchange(seed, classes)
    of = {w: int(start[k]) for k, w in enumerate(frequent[:first])}
    moves = np.zeros((classes, classes))
    for a in range(first):
        for b in range(first):
            moves[start[a], start[b]] += seed[a, b]
    best = {}
    for turn in range(sizes.rounds):
        weights = class_lm._likelihoods(moves)
        known = np.array([of.get(w, -1) for w in frequent], np.int16)
        leaning = class_lm._leanings(known, np.array([class_lm.ending(w) for w in frequent]), classes)
        gain = {}
        for (a, b), n in pairs.items():
            if a in of:
                gain[b] = gain.get(b, 0) + n * weights[of[a]]
            if b in of:
                gain[a] = gain.get(a, 0) + n * weights[classes + of[b]]
        best = {w: int(np.argmax(g + class_lm.LEANING * leaning[class_lm.ending(w)])) for w, g in gain.items()}
        now = {w: of[w] if index[w] < first else best[w] for w in frequent if index[w] < first or w in best}
        moved = sum(now.get(w) != of.get(w) for w in frequent)
        of = now
        if turn and moved <= sizes.moved * len(frequent):
            break
        moves = np.zeros((classes, classes))
        for (a, b), n in pairs.items():
            if a in of and b in of:
                moves[of[a], of[b]] += n
    klass = {w: of.get(w) if w in index else best.get(w) for w in counts}
    by_ending = np.zeros((class_lm.ENDINGS, classes), int)
    for w, c in klass.items():
        if c is not None:
            by_ending[class_lm.ending(w), c] += 1

    def class_of(w):
        if klass.get(w) is not None:
            return klass[w]
        row = by_ending[class_lm.ending(w)]
        return int(row.argmax() if row.any() else by_ending.sum(axis=0).argmax())

    members = Counter(class_of(w) for w in counts) + Counter([classes])
    steps, n_class = Counter(), Counter()
    for t in train:
        at = [classes, *map(class_of, t), classes]
        steps.update(zip(at, at[1:]))
        n_class.update(at[1:])
    before = Counter()
    for (a, _), n in steps.items():
        before[a] += n
    total = n_class.total()
    found = []
    for _, t in texts:
        at, score = [classes, *map(class_of, t), classes], 0.0
        for a, b, w in zip(at, at[1:], [*t, None]):
            prior = (n_class[b] + 1) / (total + classes + 1)
            score += math.log10((steps[a, b] + 5 * prior) / (before[a] + 5))
            c = len(train) if w is None else counts[w]
            score += math.log10((c + smoothing) / (n_class[b] + smoothing * (members[b] + 1)))
        found.append(score)
    return found


def test_class_scores_equal_brute_force(docs_of, documents):
    rows = [(k, t[:3000].lower()) for k, t in documents if t.isascii()][:80]
    for sizes in (class_lm.Sizes(classes=6, first=30, frequent=120), class_lm.Sizes(first=50, rounds=2)):
        found = {r["doc_id"]: r["score"] for r in class_lm.score_texts(docs_of(rows), remainder(F.col("doc_id"), 10) == 0, sizes).collect()}
        assert [found[k] for k, _ in rows] == pytest.approx(_brute_class_scores(rows, sizes), abs=1e-6)


def test_neighbours_of_words_are_added_up_across_blocks(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [rng.integers(-30, 40, rng.integers(0, 30)) for _ in range(80)]
    numbers = spark.createDataFrame([(bytearray(r.astype(np.int64).tobytes()),) for r in rows], "numbers binary").repartition(3)
    want = Counter((a, abs(b) % 7) for r in rows for a, b in zip(r.tolist(), r.tolist()[1:]))
    monkeypatch.setattr(class_lm, "BLOCK_PAIRS", 200)

    def pairs(flat, ends):
        same = class_lm._neighbours(flat, ends)
        return flat[:-1][same], np.abs(flat[1:][same]) % 7

    entries = class_lm._entries_of_words(numbers, lambda: pairs)
    found, words = Counter(), []
    held = sorted((r["x"], bytes(r["found"])) for r in entries.collect())
    batches = [pa.RecordBatch.from_arrays([pa.array([x for x, _ in held[k:k + 5]], pa.int64()), pa.array([b for _, b in held[k:k + 5]], pa.binary())],
                                          names=["x", "found"]) for k in range(0, len(held), 5)]
    for x, starts, y, n in class_lm._by_word(iter(batches)):
        words += x.tolist()
        found.update({(int(a), int(b)): int(c) for a, b, c in zip(np.repeat(x, np.diff(starts)), y, n)})
    assert found == want and words == sorted(set(words))
    assert len({x for x, _ in held}) < len(held) < len(want)  # fewer rows meet in the shuffle than there are pairs


class _Task:
    """Stands for a table, and keeps the function that its tasks would run."""

    def select(self, *_):
        return self

    def mapInArrow(self, function, schema):  # noqa: N802
        self.function = function
        return self

    def to_numpy(self):
        return np.empty(0, np.int64)

    def __getattr__(self, name):
        return lambda *_: self

    def most_held(self, batches):
        """Bytes of numpy arrays that the task holds at most."""
        tracemalloc.start()
        for _ in self.function(iter(batches)):
            pass
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return most


def test_a_task_that_adds_up_pairs_holds_few_of_them(spark):
    rng = np.random.default_rng(4)
    size, rows = 5_000_000, 5_000

    def table(flat):
        return pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in flat.reshape(rows, -1)])], names=["numbers"])

    def both_sides(flat, ends):
        return np.concatenate([flat[1:], flat[:-1]]), np.concatenate([flat[:-1] % 50, 50 + flat[1:] % 50])

    task = _Task()
    class_lm._entries_of_words(task, lambda: both_sides)
    numbers = table(rng.integers(0, 100_000, size))
    assert task.most_held([numbers.slice(k, rows // 5) for k in range(0, rows, rows // 5)]) < 50 * class_lm.BLOCK_PAIRS

    class_lm._counted(task, "numbers", 50, lambda: lambda flat, ends: (flat[:-1].astype(np.int64), flat[1:].astype(np.int64)), np.uint8)
    assert task.most_held([table(rng.integers(0, 50, size).astype(np.uint8))]) < 8 * size


def test_pairs_are_added_up_in_equal_blocks(spark, monkeypatch):
    monkeypatch.setattr(class_lm, "BLOCK_PAIRS", 200)
    monkeypatch.setattr(class_lm, "BLOCK_ROWS", 3, raising=False)
    rows = [(bytearray(np.arange(151, dtype=np.int64).tobytes()),) for _ in range(7)]

    def pairs(flat, ends):
        return flat[:-1] // 30, flat[1:] % 2

    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    try:
        entries = class_lm._entries_of_words(spark.createDataFrame(rows, "numbers binary").coalesce(1), lambda: pairs).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    counts = [(r["x"], np.frombuffer(r["found"], class_lm.ENTRY)) for r in entries]
    blocks = [range(at, min(1050, at + 200)) for at in range(0, 1050, 200)]  # which end within a text
    assert Counter(x for x, _ in counts) == Counter(x for block in blocks for x in {k % 150 // 30 for k in block})
    assert sum(int(e["n"].sum()) for _, e in counts) == 1050


def test_rounds_leave_no_tables_behind(docs_of, documents, monkeypatch):
    kept, freed, stored = [], [], class_lm.stored
    monkeypatch.setattr(class_lm, "stored", lambda df: kept.append(stored(df)) or kept[-1])
    monkeypatch.setattr(class_lm, "forget_shuffles", lambda spark: freed.append(spark))
    class_lm.score_texts(docs_of(documents[:60]), F.lit(False), class_lm.Sizes(classes=6, first=30, frequent=2000, moved=0.0)).collect()
    rounds = [t for t in kept if t.columns == ["number", "class"]]
    assert len(freed) == len(rounds) > 1
    assert [all(os.path.exists(f.removeprefix("file://")) for f in t.inputFiles()) for t in rounds] == [False] * (len(rounds) - 1) + [True]


def test_exchange_finds_classes_that_alternate():
    counts = np.zeros((6, 6))
    counts[:3, 3:] = 10
    counts[3:, :3] = 10
    found = class_lm.exchange(counts, 2)
    assert len(set(found[:3])) == len(set(found[3:])) == 1 and found[0] != found[3]


def _labelled(spark, n=400):
    """Documents whose label shows in a word, and junk whose label shows in its form."""
    rng = np.random.default_rng(1)
    docs, labels = [], []
    for k in range(n):
        text = [f"w{rng.integers(0, 300)}" for _ in range(60)]
        bad = k % 4 == 0
        if bad:
            text = ["horrid" if rng.random() < 0.15 else x.upper() + "!!" for x in text]
        docs.append((k, " ".join(text)))
        labels.append((k, int(not bad), int(bad)))
    labels += [(1, 0, 1), (None, 1, 1), (5, None, None), (9999, 1, 0)]
    return docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_classifiers_on_held_out_documents(spark, docs_of, odd_rows):
    docs, labels = _labelled(spark)
    odd = [(None if k is None else k + 10_000, t) for k, t in odd_rows]
    for score, label, good in ((quality.score_quality, "quality", 1), (toxicity.score_toxicity, "toxic", 0)):
        got = score(docs_of(docs + odd), labels).collect()
        assert len(got) == len(docs) + len(odd) and all(0 <= r["score"] <= 1 for r in got)
        held = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 400 and not _fold(r["doc_id"], 5)]
        right = [r["predicted"] == (good if r["doc_id"] % 4 else 1 - good) for r in held]
        assert np.mean(right) > 0.9, label
        assert score(docs_of([]), labels).collect() == []
        assert len(score(docs_of(docs[:5]), labels.limit(0)).collect()) == 5


def test_quality_query_on_held_out_labels(spark, sf_dir):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = QUERIES["op9_quality"](spark, sf_dir).collect()
    held = [r for r in rows if r["held_out"] and labels.get(r["doc_id"]) is not None]
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in held]) > 0.8


def test_pairs_of_a_word_with_few_predecessors(spark):
    # "b" comes after "a" only, and is no context; "e" after many
    rows = [("a", "b", 0, 9), *((f"v{k}", "e", 4, 4) for k in range(5)), ("a", "e", 1, 3)]
    rows = [(*(int(np.uint64(HASHES[x.encode()]).view(np.int64)) for x in r[:2]), *r[2:]) for r in rows]
    model = toxicity.ratios(spark.createDataFrame(rows, "v bigint, w bigint, n0 bigint, n1 bigint"), 2.0)
    at = {x: model.place(x.encode()) for x in ("a", "b", "e")}
    assert min(at.values()) >= 0
    pairs = {(int(c) // len(model.vocabulary), int(c) % len(model.vocabulary)): r for c, r in zip(model.pairs, model.pair)}
    assert len(pairs) == len(rows) and np.isfinite(list(pairs.values())).all()
    assert pairs[at["a"], at["b"]] > 1 and math.isclose(model.unigram[at["b"]], model.unknown)


def test_licenses(spark):
    prose = "of the and in a to is that it as was for " * 5
    rows = [
        ("a/LICENSE", "Released under the MIT License."), ("a/b/c/code.py", prose), ("a/b/COPYING", "Licensed under CC BY-NC 4.0."),
        ("a/b/x.py", f"{prose}\nLicensed under the Apache License, Version 2.0.\n{prose}"), ("a/y.py", prose), ("z.py", prose),
        ("a/none", None), (None, "Released under the MIT License."), ("a/y.py", prose), ("", ""),
    ] + [(f"p/{k}", prose) for k in range(50)]
    files = spark.createDataFrame([(k, *r, 1, 2) for k, r in enumerate(rows)], "n int, path string, text string, dir int, term int")
    got = {r["n"]: (r["license"], r["via"], r["distance"]) for r in licenses.scan_licenses(files, keep=("n",)).collect()}
    assert [got[k] for k in range(10)] == [
        ("MIT", "file", None), ("CC-BY-NC-4.0", "inherited", 1), ("CC-BY-NC-4.0", "file", None), ("Apache-2.0", "header", None),
        ("MIT", "inherited", 0), (None, None, None), ("MIT", "inherited", 0), (None, None, None), ("MIT", "inherited", 0), (None, None, None)]
    assert len(got) == len(rows) and licenses.scan_licenses(files.limit(0)).collect() == []
    assert all(r["license"] is None for r in licenses.scan_licenses(files, templates=()).collect())


def test_licenses_beside_other_words(spark):
    prose = "of the and in a to is that it as was for " * 5
    said = ["Licensed under the Apache License, Version 2.0. Copyright Foo", "This file is released under the MIT License.",
            "Copyright (c) 2021 Acme. Released under the MIT License.", f"zeta Released under the MIT License {prose}", "the license of the zeta"]
    rows = [(f"d{k}/x", f"{prose}\n{x}\n{prose}") for k, x in enumerate(said)] + [(f"p{k}/x", f"{prose} w{k}") for k in range(3000)]
    got = {r["path"]: r for r in licenses.scan_licenses(spark.createDataFrame(rows, "path string, text string")).collect()}
    assert [got[f"d{k}/x"]["license"] for k in range(len(said))] == ["Apache-2.0", "MIT", "MIT", "MIT", None]
    assert [got[f"d{k}/x"]["similarity"] for k in range(4)] == [1.0] * 4


def test_neighbouring_licenses_and_full_texts(spark):
    prose = "of the and in a to is that it as was for " * 5
    said = {
        "This work is licensed under the GNU General Public License, version 2": "GPL-2.0", "Released under the BSD 2-Clause License": "BSD-2-Clause",
        "Licensed under CC BY 3.0": "CC-BY-3.0", "SPDX-License-Identifier: GPL-2.0": "GPL-2.0", "SPDX-License-Identifier: ISC": "ISC",
        "Licensed under CC BY-NC-SA 4.0": "CC-BY-NC-SA-4.0", "Licensed under the GNU Affero General Public License, version 3": "AGPL-3.0",
        "SPDX-License-Identifier: EUPL-1.2": None, "Released under the Zlib License": None,
    }
    rows = [(f"d{k}/x", f"{prose}\n{x}\n{prose}") for k, x in enumerate(said)] + [(f"p{k}/x", f"{prose} w{k}") for k in range(200)]
    texts = licenses.full_texts()
    for name, text, _ in texts:
        rows += [(f"t/{name}/words", f"Copyright 2020 Acme Inc\n{text}"), (f"t/{name}/code.py", prose)]
    got = {r["path"]: r for r in licenses.scan_licenses(spark.createDataFrame(rows, "path string, text string")).collect()}
    assert {x: got[f"d{k}/x"]["license"] for k, x in enumerate(said)} == said
    assert {name: (got[f"t/{name}/words"]["license"], got[f"t/{name}/words"]["via"]) for name, _, _ in texts} == {x: (x, "file") for x, _, _ in texts}
    assert all(got[f"t/{name}/code.py"]["license"] == name for name, _, _ in texts)


def test_license_query(spark, sf_dir, documents):
    got = {r["doc_id"]: r for r in QUERIES["op5_license_scan"](spark, sf_dir).collect()}
    assert len(got) == len(documents)
    for k, text in documents:
        lines = [x for x in (text or "").split("\n") if re.match(r"(Licensed|Released|This work is licensed) under \w|All rights reserved", x)]
        assert (got[k]["via"] in ("header", "file")) == bool(lines)


def test_pipeline_decides_by_row(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    row = lambda k, text: (k, text, "en", "s", len(text or ""))
    prose, other = (" ".join(f"{x}{k}" for k in range(60)) for x in ("w", "u"))
    rows = [row(9, prose), row(9, prose), row(9, other), row(4, other), row(None, prose), row(None, "v " + other), row(None, None), row(7, None)]
    table = spark.createDataFrame(rows, docs.select("doc_id", "text", "lang", "source", "n_chars").schema)
    one = corpus_pipeline.keep_one_of_group(spark, table, sf_dir)
    assert one.columns == table.columns
    assert sorted(map(repr, one.select("doc_id", "text").collect())) == sorted(
        map(repr, table.limit(0).sparkSession.createDataFrame([(9, prose), (4, other), (None, None), (7, None)], "doc_id bigint, text string").collect()))
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").first()["text"]
    table = spark.createDataFrame([row(None, item), row(1, item), row(1, prose), row(None, prose)], table.schema)
    clean = corpus_pipeline.drop_leaks(spark, table, sf_dir)
    assert sorted(((r["doc_id"], r["text"]) for r in clean.collect()), key=repr) == sorted([(1, prose), (None, prose)], key=repr)
    scored = {r["doc_id"]: r["predicted"] for r in QUERIES["op9_quality"](spark, sf_dir).collect()}
    bad = F.col("doc_id").isin([k for k, x in scored.items() if x == 0][:40])
    good = corpus_pipeline.keep_good(spark, docs.unionByName(docs.filter(bad).withColumn("doc_id", F.lit(None).cast("bigint"))), sf_dir)
    kept = {r["text"] for r in good.filter("doc_id is not null").collect()}
    assert {r["text"] for r in good.filter("doc_id is null").collect()} <= kept


def test_pipeline(spark, sf_dir):
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    docs = read("documents")
    good = corpus_pipeline.keep_good(spark, docs, sf_dir)
    assert good.columns == docs.columns and 0 < good.count() < docs.count()
    one = corpus_pipeline.keep_one_of_group(spark, docs, sf_dir)
    groups = jaccard_join.jaccard_groups(docs).collect()
    assert sorted(r["doc_id"] for r in one.collect()) == sorted({r["component_id"] for r in groups})
    clean = corpus_pipeline.drop_leaks(spark, docs, sf_dir)
    leaks = {r["doc_id"] for r in QUERIES["op1_decontamination"](spark, sf_dir).collect()}
    assert {r["doc_id"] for r in docs.collect()} - {r["doc_id"] for r in clean.collect()} == leaks
    masked = corpus_pipeline.mask_secrets(spark, docs, sf_dir)
    assert masked.schema == docs.schema and masked.count() == docs.count()
    assert corpus_pipeline.run(spark, sf_dir).count() > 0


def test_stages_keep_a_column_named_like_the_row_key_and_empty_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(30).withColumn("row_key", F.lit("mine"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, sf_dir)
        assert found.columns == docs.columns and {r["row_key"] for r in found.collect()} == {"mine"}, name
        assert stage(spark, docs.limit(0), sf_dir).collect() == [], name
    assert corpus_pipeline.pack_windows(spark, docs.limit(0), sf_dir).collect() == []
