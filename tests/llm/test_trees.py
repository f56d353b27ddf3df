"""Chat formatting, conversation repair and the Merkle manifest against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from marquee.llm import conversation_repair, merkle, reply_trees
from marquee.llm.queries import QUERIES, STATEMENTS

TURNS = "conv_id bigint, turn bigint, role string, text string"
# Ties, repeated rows, nulls in every column, empty and long texts, control strings, a long conversation.
ODD_TURNS = [
    (1, 0, "user", "<turn user></turn>\n"), (1, 1, "assistant", "<\\turn <\\\\/turn> </turn"), (1, 1, "assistant", "<\\turn <\\\\/turn> </turn"),
    (1, None, None, None), (None, 3, "a>b%3E%25", "x<"), (None, 4, "assistant", "\\"), (2, 0, "assistant", ""), (3, 0, "user", None),
    (4, 1, "assistant", "é中😀</tur\x00"), (4, 2, "</turn>\n<turn assistant>", "$1 \\1"), (5, 0, "assistant", "a" * 200_000),
    *[(6, i, "assistant" if i % 2 else "user", f"t{i}. <turn ") for i in range(300)],
]


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _same(found, wanted):
    assert Counter(map(tuple, found)) == Counter(wanted)


@pytest.mark.parametrize("name", list(STATEMENTS))
def test_query_equals_its_statement(spark, sf_dir, name):
    found = QUERIES[name](spark, sf_dir)
    with duckdb.connect() as con:
        for table in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
            con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
        wanted = con.sql(STATEMENTS[name])
        assert sorted(wanted.columns) == sorted(found.columns)
        _same(found.collect(), [tuple(row) for row in wanted.select(*[duckdb.ColumnExpression(c) for c in found.columns]).fetchall()])


# Chat formatting


def _digests(rows):
    of = defaultdict(list)
    for conv, turn, role, text in rows:
        of[conv].append((turn is not None, turn or 0, role or "", hashlib.md5((text or "").encode()).hexdigest(), text or ""))
    for conv, turns in of.items():
        turns.sort()
        loss = "".join(t[-1] for t in turns if t[2] == "assistant")
        yield conv, len(turns), _sha("".join(f"{t[2]}\n{t[-1]}\n" for t in turns)), len(loss), _sha(loss)


def test_conversation_digests_of_odd_rows(spark):
    rows = spark.createDataFrame([(*r, "x", 1, 2) for r in ODD_TURNS], TURNS + ", tree string, id int, score int")
    found = reply_trees.conversation_digests(rows)
    _same(found.drop("formatted_chars").collect(), _digests(ODD_TURNS))
    assert reply_trees.conversation_digests(rows.limit(0)).collect() == []


def test_escapes_are_reversible_and_leave_other_texts_alone(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice(["<", "\\", "/", "turn", ">", "\n", "x", "</turn>\n", "<turn user>"]) for _ in range(rng.randrange(12))) for _ in range(3000)]
    turns = F.array(F.struct(F.col("role"), F.col("text")), F.struct(F.lit("assistant").alias("role"), F.col("text")))
    frame = spark.createDataFrame([(t.replace("\n", ""), t) for t in texts], "role string, text string")
    frame = frame.select("role", "text", turns.alias("turns")).withColumn("parts", reply_trees.format_turns(F.col("turns")))
    frame = frame.withColumn("formatted", F.array_join(F.transform("parts", lambda p: p["text"]), ""))
    for row in frame.select("*", reply_trees.read_turns(F.col("formatted")).alias("back"), reply_trees.masked_text(F.col("parts")).alias("loss")).collect():
        assert row.back == row.turns
        assert row.loss == (row.text * 2 if row.role == "assistant" else row.text)
        if "turn" not in row.text:
            assert row.text in row.formatted


def _brute_paths(messages, branches):
    """Best root-to-leaf paths of every tree, by walking up from each leaf."""
    nodes = {}
    for tree, key, parent, score in messages:
        old = nodes.get((tree, key))
        parent = min((p for p in (parent, old[0] if old else None) if p is not None), default=None)
        nodes[tree, key] = (parent, min(score or 0, old[1]) if old else score or 0)
    up = {k: (k[0], p) if (k[0], p) in nodes else None for k, (p, _) in nodes.items()}
    replied = set(up.values())
    found = defaultdict(list)
    for node in set(nodes) - replied:
        path, at = [], node
        while at is not None and at not in path:
            path.append(at)
            at = up[at]
        if at is None:
            found[node[0]].append((-sum(nodes[n][1] for n in path) / len(path), node[1], [n[1] for n in reversed(path)]))
    for tree, paths in found.items():
        for rank, (less, leaf, path) in enumerate(sorted(paths)[:branches], 1):
            yield from ((tree, leaf, rank, -less, place, key) for place, key in enumerate(path, 1))


def test_best_paths_of_trees(spark):
    rng = random.Random(3)
    rows = []
    for t in range(30):
        size = rng.choice([1, 2, 9, 60])
        for k in range(size):
            parent = rng.choice([k - 1, rng.randrange(k) if k else None, max(0, k - 3), 999, None]) if k else rng.choice([None, 0, 7])
            rows.append((f"t{t}", k, parent, rng.choice([None, 0.0, 0.5, 1.0, 4.0])))
    rows += [("loop", 1, 2, 1.0), ("loop", 2, 1, 1.0), ("loop", 3, 1, 1.0), ("twice", 1, None, 1.0), ("twice", 1, None, 1.0), ("twice", 2, 1, 0.25)]
    rows += [("star", k, 0 if k else None, k / 8) for k in range(400)] + [("chain", k, k - 1 if k else None, 1.0) for k in range(130)]
    rows += [("self", 5, 5, 1.0)]
    frame = spark.createDataFrame(rows, "tree string, id int, parent int, score double").repartition(5)
    for branches in (1, 3):
        _same(reply_trees.best_paths(frame, branches).select("tree", "leaf", "path_rank", "score", "place", "id").collect(), _brute_paths(rows, branches))


def test_format_trees_reads_each_chosen_path(spark):
    rows = [("a", 1, None, 1.0, "user", "q"), ("a", 2, 1, 1.0, "assistant", "low"), ("a", 3, 1, 3.0, "assistant", "high"), ("b", 1, None, None, None, None)]
    frame = spark.createDataFrame(rows, "tree string, id int, parent int, score double, role string, text string")
    found = {r.tree: r for r in reply_trees.format_trees(frame).collect()}
    assert found["a"].formatted == "<turn user>q</turn>\n<turn assistant>high</turn>\n"
    assert [p.text for p in found["a"].parts if p.loss] == ["high"]
    assert found["b"].formatted == "<turn ></turn>\n"


# Conversation repair

NEXT = {"": "su", "s": "u", "u": "a", "a": "u"}
MADE = {"": "user", "s": "user", "u": "assistant", "a": "user"}


def _cheapest(turns):
    """Least (cost, audit) over the turns (initial, must go, truncated), every state keeping its best."""
    def inserted(best):
        for _ in range(4):
            for s in list(best):
                t = MADE[s][0]
                best[t] = min(best.get(t, (10 ** 9,)), (best[s][0] + 2, best[s][1] + "I"))
        return best

    best = inserted({"": (0, "")})
    for initial, must_go, cut in turns:
        new = {}
        for s, (cost, audit) in best.items():
            ways = [(s, cost + 3, "D")]
            if not must_go:
                ways += [(initial, cost + cut, "K")] if initial and initial in NEXT[s] else []
                ways += [(MADE[s][0], cost + 2 + cut, "R")]
            for t, c, e in ways:
                new[t] = min(new.get(t, (10 ** 9,)), (c, audit + e))
        best = inserted(new)
    return min(best[s] for s in ("", "a") if s in best)


def test_auction_finds_the_cheapest_edits_least_in_ascii():
    rng = random.Random(1)
    for _ in range(4000):
        codes = "".join(rng.choice("suaoSUAO--uaua") for _ in range(rng.randrange(14)))
        turns = [("" if c.lower() == "o" else c.lower(), c == "-", int(c.isupper())) for c in codes]
        assert conversation_repair.cheapest_edits(codes) == _cheapest(turns), codes


def test_auction_prices_are_exact_and_its_work_grows_with_the_turns():
    codes = "".join(random.Random(2).choice("suaoSUAO--") for _ in range(60_000))
    cost, audit = conversation_repair.cheapest_edits(codes)
    turns = [("" if c.lower() == "o" else c.lower(), c == "-", int(c.isupper())) for c in codes]
    assert cost == sum({"D": 3, "I": 2, "K": 0, "R": 2}[e] for e in audit) + sum(
        t[2] for t, e in zip(turns, audit.replace("I", "")) if e != "D")
    prices = conversation_repair.exact_prices(codes[:300])
    for k in range(301):
        rest = turns[:300][k:]
        assert prices[(300 - k) * 4 + conversation_repair.START] == _cheapest(rest)[0]


def _repaired(rows):
    of = defaultdict(list)
    for conv, turn, role, text in rows:
        turns = of[conv]
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        turns += [(turn, "user" if fault == 4 else role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    for conv, turns in of.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), hashlib.md5(t[2].encode()).hexdigest()))
        numbers = [t[0] for t in turns if t[0] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        seen, faults, coded = set(), [0, 0, 0], []
        for _, role, text in turns:
            said = text.strip(" \t\n\x0b\x0c\r")
            fault = 0 if not said else 1 if (role, text) in seen else 2 if said[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                faults[fault] += 1
            coded.append((role[:1], fault in (0, 1), int(fault == 2)))
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(coded, coded[1:]))
        cost, audit = _cheapest(coded)
        state, kept, left = "", [], iter(turns)
        for edit in audit:
            _, role, text = (None, None, "") if edit == "I" else next(left)
            if edit != "D":
                kept.append((role if edit == "K" else MADE[state], text))
                state = kept[-1][0][:1]
        assert next(left, None) is None and re.fullmatch("(s?(ua)+)?", "".join(role[:1] for role, _ in kept))
        yield conv, gaps, *faults, illegal, cost, audit, _sha("\n".join(f"{role}:{text}" for role, text in kept))


def test_repair_of_odd_rows(spark):
    rng = random.Random(7)
    rows = [(rng.randrange(7, 60), rng.choice([None, *range(12)]), rng.choice([None, "", "user", "assistant", "system", "tool", "ünter", "a"]),
             rng.choice([None, "", " \n", "ok.", "ok", "Ha! ", "a?", "x. y", "é."])) for _ in range(1500)] + ODD_TURNS
    frame = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], TURNS + ", conv string, place int, edit int").repartition(6)
    _same(conversation_repair.damaged_and_repaired(frame).collect(), _repaired(rows))
    assert conversation_repair.damaged_and_repaired(frame.limit(0)).collect() == []


def test_repaired_rows_alternate(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").filter("turn != 1 or role = 'user'")
    found = conversation_repair.repair(rows, conversation_repair.plan_repairs(rows)).filter("edit != 'D'").collect()
    of = defaultdict(str)
    for row in sorted(found, key=lambda r: (r.conv, r.place)):
        of[row.conv] += row.role[0]
    assert of and all(re.fullmatch("s?(ua)+", roles) for roles in of.values())


# Merkle manifest


def _manifest(rows, run=16):
    def field(value):
        return "-" if value is None else f"{len(str(value).encode())}:{value}"

    def leaf(row, text):
        return _sha("".join(map(field, (*row[:4], text))))

    def tree(level):
        levels = [level]
        while len(level) > 1:
            level = [_sha("".join(level[i:i + run])) for i in range(0, len(level), run)]
            levels.append(level)
        return levels

    def proof(levels, i):
        for level in levels[:-1]:
            start = i // run * run
            yield "".join(level[start:i]), "".join(level[i + 1:start + run])
            i //= run

    of = defaultdict(list)
    for row in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4]))):
        of[row[1]].append(row)
    groups = sorted(of, key=lambda s: (s is not None, (s or "").encode()))
    trees = [tree([leaf(r, r[4]) for r in of[g]]) for g in groups]
    top = tree([t[-1][0] for t in trees])
    for number, (group, levels) in enumerate(zip(groups, trees)):
        for i, row in enumerate(of[group]):
            steps = [*proof(levels, i), *proof(top, number)]
            text = row[4]
            if row[0] is not None and text is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0:
                text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
            node = leaf(row, text)
            for left, right in steps:
                node = _sha(left + node + right)
            yield (row[0], levels[0][i], levels[-1][0], top[-1][0], _sha("".join(a + b for a, b in steps)), node, node == top[-1][0])


DOCS = "doc_id bigint, source string, lang string, n_chars bigint, text string"


@pytest.mark.parametrize("sizes", [[1], [16], [17], [1, 1], [0, 256, 257, 1, 2, 33], [1] * 40 + [300]])
def test_manifest_of_sources_of_many_sizes(spark, sizes):
    rng = random.Random(len(sizes))
    rows = [(rng.randrange(-400, 4000), f"s{s}", "en", k, f"Text {k} É") for s, size in enumerate(sizes) for k in range(size)]
    _same(merkle.tampered_manifest(spark.createDataFrame(rows, DOCS).repartition(5)).collect(), _manifest(rows))


def test_manifest_of_odd_rows(spark, odd_rows):
    rows = [(k, s, lang, n, text) for k, text in odd_rows for s, lang, n in ((None, "en", 3), ("", None, None), ("ü", "de", -5))]
    rows += [(k % 3, "copies", "en", 1, "Same") for k in range(700)]
    frame = spark.createDataFrame([(*r, 1, 2, "x", "y") for r in rows], DOCS + ", lo int, n int, grp string, leaf string")
    _same(merkle.tampered_manifest(frame).collect(), _manifest(rows))
    assert merkle.tampered_manifest(frame.limit(0)).collect() == []


def test_proofs_fold_to_the_root(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = merkle.manifest(docs, merkle.row_digest(F.col("doc_id"), F.col("text")), F.col("lang"), [F.col("doc_id")], {"id": F.col("doc_id")}, run=4)
    assert found.filter(merkle.fold(F.col("leaf"), F.col("proof")) != F.col("root")).count() == 0
    assert found.filter(merkle.fold(merkle.digest(F.col("leaf")), F.col("proof")) == F.col("root")).count() == 0
