"""Merkle manifests, nearest vectors and mended conversations, against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowtables.llm import grammar, hnsw, merkle, nearest, repair, ropes


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# --- manifests


def levels(nodes):
    found = [nodes]
    while len(found[-1]) > 1:
        found.append([sha("".join(found[-1][i : i + 2])) for i in range(0, len(found[-1]), 2)])
    return found


def siblings(found, place):
    out = []
    for level in found[:-1]:
        if place ^ 1 < len(level):
            out.append(level[place ^ 1])
        place //= 2
    return out


def plain_manifest(rows):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    trees = defaultdict(list)
    for row in rows:
        doc_id, _, lang, *_ = row
        trees[lang].append(((doc_id is not None, doc_id or 0, sha("".join(map(field, row)))), doc_id))
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    built = {k: levels([leaf[-1] for leaf, _ in sorted(trees[k])]) for k in names}
    top = levels([built[k][-1][0] for k in names])
    out = []
    for at, k in enumerate(names):
        for i, (leaf, doc_id) in enumerate(sorted(trees[k])):
            proof = siblings(built[k], i) + siblings(top, at)
            tampered = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0
            out.append((doc_id, leaf[-1], built[k][-1][0], top[-1][0], sha("".join(proof)), tampered))
    return out


DOCUMENTS = "doc_id long, source string, lang string, n_chars int, text string"


def check_manifest(spark, rows, bits, monkeypatch):
    monkeypatch.setattr(merkle, "BITS", bits)
    df = spark.createDataFrame(rows, DOCUMENTS).withColumns({"leaf": F.lit(1), "tree": F.lit("x"), "place": F.lit(2)}).repartition(3)
    got = merkle.tampered_manifest(df).collect()
    want = plain_manifest(rows)
    assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted((w[:5] for w in want), key=repr)
    changed = {w[0] for w in want if w[5]}
    n_chars = {r[0]: r[3] for r in rows}
    for r in got:
        assert r.verified == (r.doc_id not in changed or n_chars[r.doc_id] is None)
        assert (r.folded_root == r.root) == r.verified


def test_manifest(spark, monkeypatch):
    rows = [(i, f"s{i % 3}", ("en", "de", "fr", "é")[i % 4 if i < 40 else 0], len(str(i)), f"text {i} é") for i in range(90)]
    rows += [(None, None, None, None, None), (200, None, None, None, None), (201, "", "", 0, ""), (202, "a", "one", 2**31 - 1, "x" * 300_000)]
    check_manifest(spark, rows, 3, monkeypatch)


def test_manifest_of_repeated_rows_and_lone_trees(spark, monkeypatch):
    rows = [(7, "s", "en", 1, "copy")] * 37 + [(7, "s", "en", 1, "other"), (None, "s", "en", 1, "x"), (None, "s", "en", 1, "x")]
    check_manifest(spark, rows, 2, monkeypatch)
    check_manifest(spark, [(1, "s", "a", 1, "x"), (2, "s", "b", 1, "x"), (3, "s", None, 1, "x")], 10, monkeypatch)
    check_manifest(spark, [(1, "s", "a", 1, "x")], 10, monkeypatch)


def test_manifest_of_nothing(spark):
    assert merkle.tampered_manifest(spark.createDataFrame([], DOCUMENTS)).collect() == []


def test_proofs_fail_for_other_leaves(spark):
    df = spark.createDataFrame([(i, "s", "en", 1, str(i)) for i in range(9)], DOCUMENTS)
    rows = merkle.manifest(df)
    folded = rows.select("root", merkle.fold(F.col("leaf"), F.col("proof")).alias("good"), merkle.fold(F.sha2(F.lit("z"), 256), F.col("proof")).alias("bad")).collect()
    assert all(r.good == r.root and r.bad != r.root for r in folded)


# --- nearest vectors


def plain_nearest(rows, every=50, k=5):
    good = [(i, np.array(v)) for i, v, *_ in rows if v and None not in v and np.isfinite(v).all() and np.any(v)]
    out = {}
    for at, (i, x) in enumerate(good):
        if i is None or i % every:
            continue
        found = []
        for other, (j, y) in enumerate(good):
            if other != at and len(x) == len(y):
                a, b = x / np.abs(x).max(), y / np.abs(y).max()
                found.append((-round(float(a @ b / np.sqrt(a @ a) / np.sqrt(b @ b)), 9), j is None, j or 0))
        out.setdefault(i, []).append(sorted(found)[:k])
    return out


def check_nearest(spark, rows):
    df = spark.createDataFrame([(*r, 5, 6) for r in rows], "vec_id long, embedding array<double>, label int, rank int, score int").repartition(3)
    got = defaultdict(list)
    for r in nearest.nearest_vectors(df).orderBy("query_id", "rank").collect():
        got[r.query_id].append((-round(r.score, 9), r.vec_id is None, r.vec_id or 0))
    for i, results in plain_nearest(rows).items():
        assert sorted(got.pop(i, [])) == sorted(sum(results, []))
    assert not got


def test_nearest(spark):
    draw = np.random.default_rng(5)
    rows = [(i, [float(x) for x in draw.normal(size=8)], 0) for i in range(300)]
    rows += [(400 + i, rows[50][1], 0) for i in range(60)]  # copies, of a query too
    rows += [(500, [2 * x for x in rows[50][1]], 0), (550, None, 0), (600, [0.0] * 8, 0), (650, [float("nan")] + [1.0] * 7, 0), (700, [1.0, None] + [1.0] * 6, 0), (750, [], 0),
             (800, [1.0, 2.0], 0), (801, [2.0, 1.0], 0), (850, [1e200, -1e200], 0), (900, [5e-324, 0.0, 0.0], 0), (None, rows[50][1], 0), (None, rows[3][1], 0), (50, rows[50][1], 1)]
    check_nearest(spark, rows)


def test_nearest_of_few_and_none(spark):
    check_nearest(spark, [(0, [1.0, 0.0], 0)])
    check_nearest(spark, [(0, [1.0, 0.0], 0), (50, [1.0, 0.1], 0), (3, [1.0, 0.0], 0)])
    check_nearest(spark, [(0, [1.0, 0.0], 0)] * 9)
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert nearest.nearest_vectors(empty).collect() == []


def test_recall_over_shards(spark, monkeypatch):
    monkeypatch.setattr(nearest, "SHARD_ROWS", 1500)
    draw = np.random.default_rng(6)
    centres = draw.normal(size=(12, 32))
    # one cluster has a third of all rows, and its vectors are near copies
    rows = [(i, [float(x) for x in centres[0] + draw.normal(size=32) * 0.02]) for i in range(1500)]
    rows += [(1500 + i, [float(x) for x in centres[i % 12] + draw.normal(size=32)]) for i in range(3000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = nearest.nearest_vectors(df)
    found = spark.createDataFrame(found.collect(), found.schema)
    assert found.count() == 90 * 5
    assert nearest.recall(df, found) >= 0.95
    assert nearest.recall(df, found.where("rank > 1")) < 0.85


def test_index_is_flat_arrays_of_all_vectors(spark):
    draw = np.random.default_rng(7)
    df = spark.createDataFrame([(i, [float(x) for x in draw.normal(size=4)]) for i in range(500)], "vec_id long, embedding array<double>")
    index = nearest.build_index(df)
    nodes = index.nodes.collect()
    assert len(nodes) == 500 and all(len(n.links) == hnsw.M * (n.depth + 1) for n in nodes)
    assert max(n.depth for n in nodes) > 1 and all(set(n.links) <= {-1, *range(500)} for n in nodes)


# --- conversations

CHANGES = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
FULL = {"u": "user", "a": "assistant"}


def order(row):
    return row[0] is not None, row[0] or 0, row[1], hashlib.md5(row[2].encode()).hexdigest()


def plain_repair(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, turns) by a table over rows and states."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=order)
    seen, found, counts = set(), [], Counter()
    for _, role, text in rows:
        visible = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not visible else "duplicate" if (role, text) in seen else "truncated" if visible[-1] not in ".!?" else ""
        seen.add((role, text))
        counts[fault] += 1
        found.append((role, text, fault))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(found, found[1:]))

    def put(best, state, way):
        if state not in best or way[:2] < best[state][:2]:
            best[state] = way
            return True
        return False

    def with_inserts(best):
        while any([put(best, CHANGES[q][s], (c + 2, a + "I", out + [(FULL[q], "")])) for s, (c, a, out) in [*best.items()] for q in "ua" if s in CHANGES[q]]):
            pass
        return best

    best = {0: (0, "", [])}
    for role, text, fault in found:
        after = {}
        for s, (c, a, out) in with_inserts(best).items():
            put(after, s, (c + 3, a + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            more = fault == "truncated"
            if s in CHANGES.get(role[:1], {}):
                put(after, CHANGES[role[0]][s], (c + more, a + "K", out + [(role, text)]))
            for q in "ua":
                if s in CHANGES[q]:
                    put(after, CHANGES[q][s], (c + 2 + more, a + "R", out + [(FULL[q], text)]))
        best = after
    best = with_inserts(best)
    cost, audit, out = min((best[s] for s in (0, 3) if s in best), key=lambda w: w[:2])
    return gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, out


def plain_damage(conv_id, turn, role, text):
    name = lambda v: " " if v is None else str(v)
    fate = zlib.crc32(f"{name(conv_id)}:{name(turn)}".encode()) % 20
    role, text = name(role), name(text)
    text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
    return [(turn, "user" if fate == 4 else role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)


def conversations(seed=1):
    draw = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", None, "user", "assistant"]
    texts = ["a.", "b", "  ", "", "c! ", None, "d?\t", " ", "é.", " ", "x" * 40_000 + "."]
    return [(c, draw.choice([None, *range(12)]), draw.choice(roles), draw.choice(texts)) for c in [None, *range(120)] for _ in range(draw.choice([0, 1, 2, 5, 9, 40]))]


TURNS = "conv_id long, turn long, role string, text string"


def test_damaged_conversations(spark):
    rows = conversations()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], TURNS + ", cost int, part string")
    by_conv = defaultdict(list)
    for c, *row in rows:
        by_conv[c] += plain_damage(c, *row)
    want = {}
    for c, own in by_conv.items():
        *numbers, out = plain_repair(own)
        want[c] = (*numbers, sha("\n".join(f"{r}:{x}" for r, x in out)))
    got = repair.damaged_and_repaired(df).collect()
    assert {r.conv_id: tuple(r)[1:] for r in got} == want and len(got) == len(want)


def test_repaired_turns_of_cut_conversations(spark, monkeypatch):
    monkeypatch.setattr(repair, "CHUNK_ROWS", 16)
    draw = random.Random(2)
    rows = [(1, t, draw.choice(["user", "assistant", "system", "tool"]), draw.choice(["", "a", "b."]) + str(t) * draw.choice([0, 1])) for t in range(400)]
    rows += [(2, 0, "user", "q?"), (2, 1, "assistant", "a."), (3, 0, "system", "only.")] + [(4, 0, "user", "again.")] * 50
    df = spark.createDataFrame(rows, TURNS)
    got = defaultdict(list)
    for r in repair.repair_conversations(df).orderBy("conv_id", "place").collect():
        assert r.place == len(got[r.conv_id])
        got[r.conv_id].append((r.role, r.text))
    audits = {r.conv_id: tuple(r)[1:] for r in repair.audit_conversations(df).collect()}
    for c in (1, 2, 3, 4):
        *numbers, out = plain_repair([r[1:] for r in rows if r[0] == c])
        assert audits[c] == tuple(numbers)
        assert got[c] == out


def test_no_conversations(spark):
    df = spark.createDataFrame([], TURNS)
    assert repair.damaged_and_repaired(df).collect() == [] and repair.repair_conversations(df).collect() == []


def test_grammar_gives_its_sequences_back(spark):
    draw = random.Random(3)
    sequences = [[draw.randrange(3) for _ in range(draw.choice([0, 1, 2, 30, 200]))] for _ in range(60)] + [[1] * 97, [1] * 64, []]
    df = spark.createDataFrame([*enumerate(sequences)], "id int, codes array<int>")
    coded, rules = grammar.compress(df, 3)
    assert rules and coded.agg(F.sum(F.size("codes"))).first()[0] < sum(map(len, sequences)) / 2

    def expanded(symbol):
        return [symbol] if symbol < 3 else [s for x in rules[symbol - 3] for s in expanded(x)]

    assert {r.id: [s for c in r.codes for s in expanded(c)] for r in coded.collect()} == dict(enumerate(sequences))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("DIKR", max_size=4), max_size=8), st.lists(st.text("DIKR", max_size=4), max_size=8))
def test_ropes_compare_as_texts(a, b):
    built = []
    for parts in (a, b):
        rope = ropes.leaf("")
        for i, part in enumerate(parts):
            rope = ropes.join(rope, ropes.leaf(part)) if i % 2 else ropes.join(ropes.leaf(""), ropes.join(rope, ropes.leaf(part)))
        built.append(rope)
        assert ropes.text_of(rope) == "".join(parts)
    assert ropes.less(*built) == ("".join(a) < "".join(b))
