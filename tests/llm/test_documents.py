"""Operators on documents against brute force, on a small table with odd rows."""

import itertools
import os
import random
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flowtables.llm import fuzzy_lines, language, leaks, mixing, near_texts, quality, shards, token_files
from flowtables.llm.components import connected_components
from flowtables.llm.words import shingles, word_hashes
from flowtables.plans import sizes

public_tokenizers = pytest.importorskip("public_tokenizers")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")

WORDS = [f"{a}{b}" for a in ("ba", "ke", "li", "mo", "nu", "ra") for b in ("tor", "san", "vel", "dim", "gax", "pol", "wyn")]
SCHEMA = "doc_id long, text string, lang string, source string, size long, shard int, h long, fp string, n long"


def sentence(draw, n):
    return " ".join(draw.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(3)
    texts = [sentence(draw, draw.randint(20, 120)) for _ in range(40)]
    for i in range(12):  # near copies: one word or two changed
        words = texts[i].split(" ")
        for _ in range(1 + i % 2):
            words[draw.randrange(len(words))] = "changed"
        texts.append(" ".join(words))
    texts += [texts[3]] * 4 + [None, None, "", "", "  \n ", "...", "one two", "one two", "A\n\nb  C\t d   e\n", "x<|endoftext|>y   z \n  w"]
    texts.append(sentence(draw, 6000))
    out = [(i, t, "aa" if i % 3 else None, f"s{i % 4}" if i % 5 else None, 7, 1, 2, "f", 3) for i, t in enumerate(texts)]
    return out + [out[0], out[44], (None, texts[5], None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def sets_of(texts):
    hashes, at = shingles(*word_hashes(pa.array(texts, pa.string())))
    return [frozenset(hashes[a:b].tolist()) for a, b in zip(at[:-1], at[1:])]


def by_words(text):
    words, word = [], ""
    for c in (text or "").lower() + " ":
        if c.isascii() and not c.isalnum():
            words, word = words + [word] * bool(word), ""
        else:
            word += c
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def test_shingles_tell_the_same_runs_apart(rows):
    texts = [r[1] for r in rows] + ["Über, ÜBER über! a-b_c", "über ÜBER über a b c"]
    mine, plain = sets_of(texts), [by_words(t) for t in texts]
    assert [len(s) for s in mine] == [len(s) for s in plain]
    for (a, x), (b, y) in itertools.combinations(zip(mine, plain), 2):
        assert len(a & b) == len(x & y)


def test_token_files_round_trip(spark, docs, rows, none, tmp_path):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(VOCABULARY)
    path = str(tmp_path / "tokens")
    token_files.write_tokens(docs, path, VOCABULARY)
    got = sorted(((r.doc_id, r.start, list(r.ids)) for r in token_files.read_tokens(spark, path).collect()), key=lambda r: r[1])
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start = 0
    for (key, at, ids), row in zip(got, order, strict=True):
        assert (key, at, ids) == (row[0], start, whole.encode(row[1] or "", add_special_tokens=False).ids + [0])
        start += len(ids)
    digests = {(r.doc_id, r.start): r.ids_crc32 for r in token_files.read_tokens(spark, path, digest_only=True).collect()}
    assert digests == {(k, at): zlib.crc32(np.array(ids, "<u4").tobytes()) for k, at, ids in got}
    some = token_files.read_documents(spark, path, [3, 66]).collect()
    assert {(r.doc_id, tuple(r.ids)) for r in some} == {(k, tuple(ids)) for k, _, ids in got if k in (3, 66)}
    token_files.write_tokens(none, f"{path}0", VOCABULARY)
    assert token_files.read_tokens(spark, f"{path}0").collect() == []


def test_shards(docs, rows, none, spark):
    got = shards.shard_documents(docs, 4).collect()
    assert len(got) == len(rows) and got[0].__fields__.count("shard") == 1
    for s in range(4):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    homes = {}
    for r in got:
        homes.setdefault(r.text, set()).add(r.shard)
    assert all(len(v) == 1 for v in homes.values())
    assert shards.shard_documents(none, 4).collect() == []


def test_shards_cut_a_text_that_is_most_of_the_table(spark):
    rows = [(i, "same text" if i % 3 else f"text {i}") for i in range(6000)]
    got = shards.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), 8).toPandas()
    sizes = got.assign(b=got.text.str.len() + 1).groupby("shard").b.sum()
    assert len(sizes) == 8 and sizes.max() < 1.1 * sizes.mean() and sizes.min() > 0.9 * sizes.mean()


def test_shards_keep_all_rows_where_a_small_row_is_repeated_often(spark):
    """Copies with equal text and id, which a sample of rows misses all together, among other rows of a wide range."""
    for hot in (30001, 30101):
        rows = [(hot, 0, 1) if i % 20 == 0 else (i, i, 1) for i in range(60_000)]
        df = spark.createDataFrame(rows, "k long, t long, n long")
        got = shards.shard(df, 2, F.col("n"), F.col("k"), F.col("t")).toPandas()
        assert len(got) == len(rows)
        for _, slots in got.groupby("shard").slot:
            assert sorted(slots) == list(range(len(slots))) and abs(len(slots) - 30_000) < 1_000
        assert got[got.k == hot].shard.nunique() == 1


def test_pivot_keeps_sums_and_expectations():
    draw = np.random.default_rng(5)
    p, size = draw.random(40), draw.integers(1, 50, 40).astype(float)
    total = np.zeros(40)
    for _ in range(3000):
        out = mixing.pivot(p, size, draw.random(40))
        assert ((out > 0) & (out < 1)).sum() <= 1 and abs((out * size).sum() - (p * size).sum()) < 1e-6
        total += out
    assert abs(total / 3000 - p).max() < 0.06


def test_mix(docs, rows, none, spark):
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    words = [(r[3], len([w for w in (r[1] or "").translate({c: 32 for c in range(9, 14)}).split(" ") if w])) for r in rows]
    sizes = Counter()
    for source, n in words:
        sizes[source] += n
    left, weights = sum(sizes.values()) * 1.5, {}
    for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or ""))):
        weights[s] = (3, 1, 2)[i % 3]
    targets, open_ = {}, dict(weights)
    while open_:
        over = [s for s in open_ if left * open_[s] / sum(open_.values()) > 2 * sizes[s]]
        if not over:
            targets |= {s: left * w / sum(open_.values()) for s, w in open_.items()}
            break
        for s in over:
            targets[s] = 2 * sizes[s]
        left -= sum(targets[s] for s in over)
        open_ = {s: w for s, w in open_.items() if s not in over}
    for s in sizes:
        own = [r for r in got if r.source == s]
        assert all(abs(r.target - targets[s]) < 1e-6 and r.source_size == sizes[s] for r in own)
        assert abs(sum(r.size * r.copies for r in own) - targets[s]) <= max(r.size for r in own) / 2 + 1
        assert all(0 <= r.copies <= 2 for r in own)
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.copies)
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(key, got)) == sorted(map(key, again))
    assert mixing.mix_documents(docs).count() == sum(r.copies for r in got)
    assert mixing.mix_documents(docs).columns == docs.columns
    assert mixing.mix(none).collect() == [] and mixing.mix_documents(none).collect() == []


def test_near_texts(docs, rows, none):
    own = sets_of([r[1] for r in rows])
    links, edges = Counter(), []
    for (i, a), (j, b) in itertools.combinations(enumerate(own), 2):
        if a and b and len(a & b) / len(a | b) >= 0.8:
            links[i] += 1
            links[j] += 1
            edges.append((i, j))
    root = list(range(len(rows)))
    for _ in rows:
        for i, j in edges:
            root[i] = root[j] = min(root[i], root[j])
    got = near_texts.join_near_texts(docs).collect()
    mine = Counter((r.doc_id, r.n_links) for r in got)
    assert mine == Counter((r[0], links[i]) for i, r in enumerate(rows))
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(root[i], set()).add(r[0])
    least = {min(g, key=lambda x: (x is not None, x or 0)) for g in groups.values()}
    assert {r.class_id for r in got} == least
    kept = near_texts.one_of_each(docs)
    assert kept.columns == docs.columns
    worded = [r for r in kept.collect() if by_words(r.text)]
    assert len(worded) == sum(any(own[i] for i, _ in enumerate(rows) if root[i] == g) for g in groups)
    assert near_texts.join_near_texts(none).collect() == []


def test_near_texts_in_a_large_group(spark):
    """One text with a few hundred variants: more than a block, each pair compared once."""
    draw = random.Random(9)
    base = [draw.choice(WORDS) for _ in range(120)]
    texts = []
    for i in range(600):
        words = list(base)
        words[draw.randrange(120)] = f"w{i}"
        texts.append(" ".join(words))
    own = sets_of(texts)
    want = Counter()
    for i, j in itertools.combinations(range(600), 2):
        if len(own[i] & own[j]) / len(own[i] | own[j]) >= 0.8:
            want[i] += 1
            want[j] += 1
    got = {r.doc_id: r.n_links for r in near_texts.join_near_texts(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert sum(got[i] != want[i] for i in range(600)) == 0


def test_leaks(spark, docs, rows, none):
    draw = random.Random(8)
    long = rows[[len(r[1] or "") for r in rows].index(max(len(r[1] or "") for r in rows))][1].split(" ")
    items = [(1, " ".join(long[500:530])), (2, " ".join([*long[900:940], "other", "end"])), (3, "one, TWO!"), (4, None), (5, "  "),
             (6, sentence(draw, 30) + " never"), (1, rows[7][1]), (8, " ".join([*long[900:912], *["away"] * 12]))]
    benchmark = spark.createDataFrame([(*i, 5) for i in items], "item_id long, text string, doc_id long")
    own, sought = [by_words(r[1]) for r in rows], [by_words(t) for _, t in items]
    want = Counter(
        (r[0], items[k][0], len(own[i] & s), len(s)) for i, r in enumerate(rows) for k, s in enumerate(sought) if s and len(own[i] & s) >= 0.8 * len(s)
    )
    got = Counter((r.doc_id, r.item_id, r.shared, r.item_shingles) for r in leaks.find_leaks(docs, benchmark).collect())
    assert got == want and len(want) >= 5
    left = leaks.without_leaks(docs, benchmark)
    assert left.columns == docs.columns
    assert left.count() == sum(r[0] not in {k[0] for k in want} for r in rows)
    assert leaks.find_leaks(none, benchmark).collect() == [] and leaks.find_leaks(docs, benchmark.limit(0)).collect() == []


def test_line_groups(spark, none):
    draw = random.Random(4)
    base = [sentence(draw, 300) for _ in range(6)]
    near = [" ".join([*b.split(" ")[:-1], "altered"]) for b in base]
    texts = ["\n".join([base[0], "Same  Line", "", base[1]]), "\n".join([near[0], "same line\t", base[2]]), None, "", near[1] + "\n\n" + base[3], base[0]]
    rows = [(i, t, "x", 1, 2) for i, t in enumerate(texts)] + [(None, base[3], "x", 1, 2), (5, base[0], "x", 1, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, l string, line_no int, h int")
    got = fuzzy_lines.line_groups(docs).collect()
    lines = [(r[0], k, " ".join(x.lower().split())) for r in rows if r[1] is not None for k, x in enumerate(r[1].split("\n"))]
    assert len(got) == len(lines)
    texts_of = {(a, b): t for a, b, t in lines}
    root = {t: t for *_, t in lines if t}
    place = {t: min(((a is not None, a or 0), b) for a, b, x in lines if x == t) for t in root}
    for _ in range(3):
        for (k, s), (m, t) in itertools.combinations(texts_of.items(), 2):
            if s and t and s != t:
                x, y = s.split(" "), t.split(" ")
                if sum(a != b for a, b in zip(x, y)) + abs(len(x) - len(y)) <= 0.2 * max(len(x), len(y)):
                    root[s] = root[t] = min(root[s], root[t], key=place.get)
    assert sum(root[t] != t for t in root) >= 1
    for r in got:
        t = texts_of[(r.doc_id, r.line_no)]
        if not t:
            assert r.kept and r.first_line_no is None
        else:
            (known, key), line = place[root[t]]
            assert (r.first_doc_id, r.first_line_no) == (key if known else None, line)
            assert r.n_lines == sum(root[x] == root[t] for *_, x in lines if x)
    assert sum(r.kept for r in got) == len({root[t] for *_, t in lines if t}) + sum(not t for *_, t in lines)
    clean = {(r.doc_id, r.text) for r in fuzzy_lines.without_repeated_lines(docs).collect()}
    assert (0, texts[0].replace(base[0] + "\n", "") if root[base[0]] != base[0] else texts[0]) in clean and (2, None) in clean and (3, "") in clean
    assert fuzzy_lines.line_groups(none).collect() == []


def test_fuzzy_lines_leave_little_on_disk(spark):
    """Votes are not written, and blocks only once for each line, and only those that lines share again."""
    draw = random.Random(23)
    texts = ["\n".join(" ".join(f"{draw.randrange(10**6)}x" for _ in range(n)) for n in (12, 20, 130)) for _ in range(600)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    sizes.scratch_path(spark, "any")
    folder = f"{sizes.shared_dir(spark)}/flowtables/{spark.sparkContext.applicationId}"
    before = sizes.table_bytes(spark, folder)
    got = fuzzy_lines.line_groups(docs)
    left = sizes.table_bytes(spark, folder) - before
    assert got.count() == 1_800 and left < 0.45 * sum(map(len, texts))


def test_written_tables_leave_no_shuffle_files(spark):
    """Shuffle files of a written table go with its write, not with the driver's garbage."""
    folders = list(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())
    held = lambda: sum(f.startswith("shuffle_") and f.endswith(".data") for d in folders for *_, fs in os.walk(d) for f in fs)
    before, setting = held(), spark.conf.get(sizes.CLEANUP)
    path, rows = sizes.write_table(spark.range(5_000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count(), "any")
    for _ in range(50):
        if held() <= before:
            break
        time.sleep(0.1)
    assert held() <= before and rows.count() == 7 and spark.conf.get(sizes.CLEANUP) == setting
    sizes.delete_table(spark, path)


def test_line_sketches(spark):
    """SimHashes by their definition, and masks that lose no pair, of few and of many words, equal lines once."""
    draw = random.Random(31)
    lines = [" ".join(f"w{draw.randrange(400)}" for _ in range(n)) for n in (1, 5, 119, 120, 121, 240, 241, 700)]
    lines += [" ".join(edited(draw, lines[4].split(" "), 24)), lines[1]]
    words = sorted({w for x in lines for w in x.split(" ")})
    codes = {r.w: r.x % 2**64 for r in spark.createDataFrame([(w,) for w in words], "w string").selectExpr("w", "xxhash64(w) AS x").collect()}
    table = spark.createDataFrame([(i, 0, x) for i, x in enumerate(lines)] + [(99, 0, None)], "doc_id long, line_no int, l string")
    got = fuzzy_lines.line_hashes(fuzzy_lines.line_votes(table))
    rows = {r.l: r for r in got.join(table.where("doc_id < 9").selectExpr("xxhash64(l) AS h", "l"), "h").collect()}
    assert len(rows) == got.count() == 9
    for text, r in rows.items():
        own = [codes[w] for w in text.split(" ")]
        assert r.words == len(own) and r.sim % 2**64 == sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in own) > len(own))
    a, b = ([rows[lines[k]][m] for m in fuzzy_lines._masks()] for k in (4, 8))
    assert sum(((x & ~y) % 2**64).bit_count() for x, y in zip(a, b)) <= 24


def edits(x, y):
    """Edit distance of two lists."""
    row = list(range(len(y) + 1))
    for i, a in enumerate(x, 1):
        last, row[0] = row[0], i
        for j, b in enumerate(y, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (a != b))
    return row[-1]


def edited(draw, words, n):
    """``n`` words put in, taken out or exchanged."""
    words = list(words)
    for k in range(n):
        i, kind = draw.randrange(len(words)), draw.randrange(3)
        words[i : i + (kind != 0)] = [] if kind == 1 else [f"new{draw.randrange(10**6)}"]
    return words


def test_fuzzy_lines_recall_by_length(spark):
    """Pairs by edit similarity alone, of each length with one edit and as many as 0.8 allows; none else."""
    draw = random.Random(21)
    vocabulary = ["".join(draw.choice("aeiourstlnm") for _ in range(draw.randrange(1, 9))) for _ in range(3000)]
    pairs = []
    for kind, n in [("w", 3), ("w", 4), ("w", 5), ("w", 8), ("w", 10), ("w", 20), ("w", 30), ("w", 50), ("w", 100), ("w", 250), ("c", 12), ("c", 40)]:
        for most in sorted({1, n // 5, n // 4} - {0}):
            for _ in range(160 if n < 200 else 60):
                pool = vocabulary if kind == "w" else [chr(c) for c in range(0x4E00, 0x5800)]
                base = [draw.choice(pool) for _ in range(n)]
                other = edited(draw, base, most) if kind == "w" else [x if len(x) == 1 else draw.choice(pool) for x in edited(draw, base, most)]
                if base != other:
                    join = (" " if kind == "w" else "").join
                    pairs.append((kind, n, most, base, other, join(base), join(other)))
    docs = spark.createDataFrame([(i, p[5] + "\n" + p[6]) for i, p in enumerate(pairs)], "doc_id long, text string")
    linked = {r.doc_id for r in fuzzy_lines.line_groups(docs).collect() if r.line_no == 1 and not r.kept and r.first_doc_id == r.doc_id}
    caught = {}
    for i, (kind, n, most, base, other, *_) in enumerate(pairs):
        if edits(base, other) <= max(len(base), len(other)) * 0.2 + 1e-9:
            caught.setdefault((kind, n, most), []).append(i in linked)
        else:
            assert i not in linked
    assert {(k, n) for k, n, _ in caught} >= {("w", n) for n in (4, 5, 8, 10, 20, 30, 50, 100, 250)} | {("c", 12), ("c", 40)}
    for (kind, n, most), held in caught.items():
        # by number of edits where the kind has pairs enough, and all pairs of a length
        of_length = [x for (k, m, _), some in caught.items() if (k, m) == (kind, n) for x in some]
        assert sum(of_length) >= 0.9 * len(of_length) and (len(held) < 30 or sum(held) >= 0.9 * len(held)), (kind, n, most, sum(held), len(held))
    one = [x for (_, n, most), held in caught.items() if most == 1 and n >= 8 for x in held]
    assert sum(one) >= 0.98 * len(one)


def test_words_that_share_a_character_are_told_apart(spark, monkeypatch):
    """With few characters for words most words share one: the places of a pair's words decide."""
    monkeypatch.setattr(fuzzy_lines, "CODES", 64)
    draw = random.Random(3)
    base = [f"word{i}" for i in range(40)]
    lines = [" ".join(edited(draw, base, n)) for n in (0, 2, 5, 8, 12, 16, 20) for _ in range(6)]
    docs = spark.createDataFrame([(0, "\n".join(lines))], "doc_id long, text string")
    distinct = spark.createDataFrame([(x,) for x in sorted(set(lines))], "l string").selectExpr("xxhash64(l) AS h", "l", "struct(0L AS doc_id) AS first")
    hashes = {r.h: r.l for r in distinct.collect()}
    pairs = distinct.selectExpr("h AS a").crossJoin(distinct.selectExpr("h AS b")).where("a < b")
    got = {(r.a, r.b) for r in fuzzy_lines.similar(pairs, distinct, docs, "doc_id", "text", 0.8).collect()}
    split = {h: x.split(" ") for h, x in hashes.items()}
    near = lambda x, y: edits(x, y) <= max(len(x), len(y)) * 0.2 + 1e-9
    assert got == {(a, b) for a in split for b in split if a < b and near(split[a], split[b])} and got


def test_kneser_ney_sums_to_one_and_matches_the_formula():
    grams = {"aa": Counter(), "bb": Counter()}
    for lang, text in (("aa", "abracadabra abba"), ("bb", "xyzzy xyz zyx")):
        padded = "  " + text + " "
        for i in range(2, len(padded)):
            grams[lang][padded[i - 2 : i + 1]] += 1
    model = language.kneser_ney(grams, 3)
    letters = sorted({g[-1] for v in grams.values() for g in v})
    codes = lambda s: np.frombuffer(s.encode("utf-32-le"), np.uint32)
    for context in ("ab", "xy", "qq", "  "):
        rows = np.concatenate([model._logs(codes(context + c), np.array([2]), 3) for c in [*letters, "Ж"]])
        assert np.allclose(np.exp(rows).sum(axis=0), 1, atol=1e-5)
    c = Counter(grams["aa"])
    d3 = sum(v == 1 for v in c.values()) / (sum(v == 1 for v in c.values()) + 2 * sum(v == 2 for v in c.values()))
    two = Counter(g[1:] for g in c)
    assert set(two) and 0 < d3 < 1
    entropy, n, has = model.entropies(["abra cab", "zyxxy", None, "12 !"])
    assert entropy[0].argmin() == 0 and entropy[1].argmin() == 1 and list(has) == [True, True, False, False]


def test_calibration_takes_distinct_long_texts_of_each_language(spark, monkeypatch):
    """Short or repeated texts of least hash do not take the places of others."""
    draw = random.Random(12)
    texts = [("aa", sentence(draw, 80)) for _ in range(6)] + [("bb", " ".join(x[::-1] for x in sentence(draw, 80).split(" "))) for _ in range(6)]
    texts += [("aa", f"few {i}") for i in range(40)] + [("aa", "")] * 40 + [texts[0]] * 60
    docs = spark.createDataFrame(texts, "lang string, text string")
    scored, plain = [], language._scored
    monkeypatch.setattr(language, "CALIBRATION_DOCUMENTS", 4)
    monkeypatch.setattr(language, "_scored", lambda rows, *more: scored.extend(rows.collect()) or plain(rows, *more))
    model = language.train(docs)
    assert Counter(r.lang for r in scored) == {"aa": 4, "bb": 4} and len({r.text for r in scored}) == 8
    assert min(len(r.text) for r in scored) >= 200 and np.isfinite(model.limits).all()


def test_calibration_takes_all_long_texts(spark, monkeypatch):
    """More texts of a language than any sample held are all scored, and each counts once."""
    draw = random.Random(13)
    texts = [("aa", sentence(draw, 60)) for _ in range(2_100)]
    docs = spark.createDataFrame([*texts, *texts[:50], ("aa", "few"), (None, texts[0][1])], "lang string, text string")
    scored, plain = [], language._scored
    monkeypatch.setattr(language, "_scored", lambda rows, *more: scored.append(plain(rows, *more)) or scored[-1])
    model = language.train(docs)
    got = scored[0].select("h", "bits").distinct().collect()
    assert len({r.h for r in got}) == len({t for _, t in texts if len(t) >= 200}) > 2_000
    bits = sorted({r.h: r.bits for r in got}.values())
    assert abs(sum(b <= model.limits[0] for b in bits) / len(bits) - language.QUANTILE) < 2e-3


def _rich(draw: random.Random, n: int, low: int) -> str:
    """A text of nearly as many different grams as characters."""
    return "".join(chr(low + draw.randrange(60)) if draw.random() < 0.85 else " " for _ in range(n)) + "a"


@pytest.mark.parametrize("block", [None, 20_000])
def test_language_model_holds_all_grams(spark, monkeypatch, block):
    """Counts, discounts and chances come from all grams, however many a language has and in how many
    blocks they are sent."""
    if block:
        monkeypatch.setattr(language, "BLOCK_GRAMS", block)
    draw = random.Random(14)
    texts = [("aa", _rich(draw, 2_000, 0x430)) for _ in range(65)] + [("bb", _rich(draw, 2_000, 0x440)) for _ in range(3)]
    grams: dict[str, Counter] = {"aa": Counter(), "bb": Counter()}
    for lang, text in texts:
        symbols, at, _ = language.spell([text], 4)
        spelled = "".join(map(chr, symbols))
        grams[lang].update(spelled[i - 3 : i + 1] for i in range(3, len(spelled)))
    assert len(grams["aa"]) > 100_000
    true = language.kneser_ney(grams, 4)
    asked = [t[i : i + 300] for _, t in texts[::6] for i in (0, 900)] + [_rich(draw, 300, 0x435), "zz y", None, "12"]
    entropy, chars, has = true.entropies(asked)
    model = language.train(spark.createDataFrame(texts, "lang string, text string"))
    rows = spark.createDataFrame(list(enumerate(asked)), "id long, text string")
    got = {r.id: r for r in language._scored(rows, model, ["id long"], lambda b: [b["id"]]).collect()}
    assert [got[i].chars for i in range(len(asked))] == chars.tolist()
    assert [got[i].best for i in range(len(asked)) if has[i]] == [true.langs[k] for k, h in zip(entropy.argmin(axis=1), has) if h]
    assert np.allclose([got[i].bits for i in range(len(asked)) if has[i]], entropy.min(axis=1)[has], rtol=1e-6)
    docs = spark.createDataFrame([(i, "aa", t) for i, t in enumerate(asked)], "doc_id long, lang string, text string")
    kept = language.of_known_language(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} <= {i for i, h in enumerate(has) if h}


def test_languages(spark, docs, rows, none):
    got = language.identify(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.lang_pred in ("aa", "und")
    text = Counter((r.doc_id, r.lang_pred == "und") for r in got)
    assert text == Counter((r[0], not any(c.isalpha() for c in r[1] or "")) for r in rows)
    assert language.identify(none).collect() == [] and language.of_known_language(none).collect() == []
    assert language.of_known_language(docs).columns == docs.columns


def test_quality(spark, rows, docs, none):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)] + [(1, None, 0), (None, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int")
    got = quality.score_quality(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert {r.score for r in quality.score_quality(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.score_quality(none, labels).collect() == []


def test_quality_learns_what_one_passage_shows(spark):
    draw = random.Random(2)
    rows, marks = [], []
    for i in range(600):
        parts = [sentence(draw, 48) for _ in range(5)]
        if i % 2:
            parts[draw.randrange(5)] = " ".join(w + "%%" for w in sentence(draw, 48).split(" "))
        rows.append((i, "\n".join(parts)))
        marks.append((i, 1 - i % 2, 0))
    got = quality.score_quality(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, quality int, toxic int"))
    held = [r for r in got.collect() if r.held_out]
    assert sum(r.predicted == 1 - r.doc_id % 2 for r in held) >= 0.97 * len(held)


def test_attention_gradient():
    draw = np.random.default_rng(1)
    shape = {"encode": (5, 4), "encode0": (4,), "v": (4, 3), "u": (4, 3), "a": (3,), "out": (4,), "out0": (1,)}
    w = {k: draw.normal(size=s) for k, s in shape.items()}
    x, heads, y = draw.normal(size=(9, 5)), np.array([0, 2, 3, 9]), np.array([1.0, 0, 1])
    loss = lambda w: -np.mean(y * np.log(s := quality._forward(w, x, heads)["score"]) + (1 - y) * np.log(1 - s))
    for k, g in quality._gradient(w, x, heads, y).items():
        at = tuple(0 for _ in w[k].shape)
        up = {**w, k: w[k].copy()}
        up[k][at] += 1e-6
        assert abs((loss(up) - loss(w)) / 1e-6 - g[at]) < 1e-4


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 400) if i % 100 != 99] + [(1000, i) for i in range(1001, 1300)] + [(5, 5), (None, 3), (2, 1)]
    got = dict(connected_components(spark.createDataFrame(edges, "x long, y long"), "x", "y").collect())
    assert all(got[i] == i // 100 * 100 for i in range(400)) and all(got[i] == 1000 for i in range(1000, 1300))
    assert connected_components(spark.createDataFrame([], "x long, y long"), "x", "y").collect() == []
