"""Operators on pages and vectors, the pipeline, and the registry."""

import itertools
import os

import numpy as np
import pytest
from check import compare, oracle

from flowtables.llm import neighbours, url_rules
from flowtables.llm.queries import ORACLES, QUERIES, RULES

SF_DIR = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def test_urls(spark):
    link = '<html><head><LINK rel="canonical" href="{}"></head></html>'
    fresh = '<meta http-equiv="refresh" content="0; url={}">'
    pages = [
        (1, "http://a.example.com/de/x?q=1#f", None),  # block
        (2, "https://other.test/p", link.format("http://a.example.com/de/x?q=1")),  # alias of 1
        (3, "https://third.test/", fresh.format("//other.test/p")),  # alias of 2
        (4, "http://WWW.Example.NET/en/1", "x"),  # allow by the longer rule
        (5, "http://sub.net", None),  # no path: no rule fits
        (6, "http://sub.net/", None),
        (7, "http://b.org/fr/1", link.format("http://sub.net/")),  # allowed by rule, though its alias is blocked
        (8, "http://c.test/1", link.format("/de")),
        (9, "no url", None), (10, None, None), (11, "", ""), (4, "http://WWW.Example.NET/en/1", "x"),
        (12, "http://d.test/2", None),
        (13, "http://plain.test/a.html?utm_source=x", None),
    ]
    df = spark.createDataFrame([(*p, "x", "y") for p in pages], "page_id long, url string, html string, host string, rule string")
    redirects = spark.createDataFrame([("http://d.test/2", "http://c.test/de"), ("http://c.test/de", "http://z.net/")], "from_url string, to_url string")
    got = {r.page_id: r for r in url_rules.filter_urls(df, RULES, redirects=redirects).collect()}
    verdicts = {k: (r.rule, r.verdict) for k, r in got.items()}
    assert verdicts == {
        1: ("example.com/de/", "block"), 2: (None, "block"), 3: (None, "block"), 4: ("example.net/en/", "allow"), 5: (None, "block"),
        6: ("net/", "block"), 7: ("org/fr/", "allow"), 8: (None, "block"), 9: (None, "allow"), 10: (None, "allow"), 11: (None, "allow"),
        12: (None, "block"), 13: (None, "allow"),
    }
    assert (got[1].host, got[1].path) == ("a.example.com", "/de/x") and (got[4].host, got[5].path) == ("www.example.net", "")
    assert (got[9].host, got[9].path) == ("", "") and got[2].alias_id == got[3].alias_id
    assert url_rules.filter_urls(df, RULES).count() == len(pages)
    assert url_rules.filter_urls(df.limit(0), RULES).collect() == []


def test_links_in_comments_and_scripts_are_not_read(spark):
    link = '<link rel="canonical" href="http://a.example.com/de/x">'
    pages = [(1, "http://a.example.com/de/x", ""), (2, "http://b.test/", f"<!-- {link} -->"), (3, "http://c.test/", f"<SCRIPT>x = '{link}'</script >"),
             (4, "http://d.test/", f"<!-- no -->{link}<!--"), (5, "http://e.test/", f"<!-- {link}"), (6, "http://f.test/a.html", None), (7, "http://www.f.test/a", None)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: (r.verdict, r.alias_id) for r in url_rules.filter_urls(df, RULES, common_forms=False).collect()}
    assert {k for k, (v, _) in got.items() if v == "block"} == {1, 4}
    assert got[6][1] == "f.test/a.html" and got[7][1] == "www.f.test/a"


def test_vectors(spark):
    draw = np.random.default_rng(3)
    rows = []
    for c in range(6):  # clusters, one of them larger than a list
        base = draw.normal(size=16)
        for _ in range((40, 3, 2, 5, 2, 1)[c]):
            rows.append((len(rows), [float(x) for x in base + draw.normal(size=16) * 0.12], c % 2))
    rows += [(len(rows) + i, [float(x) for x in draw.normal(size=16)], i % 3) for i in range(150)]
    n = len(rows)
    rows += [(n, rows[0][1], 0), (n + 1, rows[0][1], 5), (n + 2, rows[0][1], None), (n + 3, None, 0), (n + 4, [0.0] * 16, 0), (n + 5, [float("nan")] * 16, 0),
             (n + 6, [1.0, None], 0), (n + 7, [], 0), (n + 8, [1e200, 1e200], 0), (n + 9, [2.0, 2.0], 0), (n, rows[0][1], 0), (None, rows[1][1], 0)]
    df = spark.createDataFrame([(*r, 4) for r in rows], "vec_id long, embedding array<double>, label int, node int").repartition(3)

    def linked(a, b):
        x, y = a[1], b[1]
        if a[2] is None or a[2] != b[2] or not x or not y or len(x) != len(y):
            return False
        if any(v is None or not np.isfinite(v) for v in x + y) or not any(x) or not any(y):
            return False
        x, y = np.array(x) / max(map(abs, x)), np.array(y) / max(map(abs, y))
        return x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.93

    links = [0] * len(rows)
    root = list(range(len(rows)))
    edges = [(i, j) for i, j in itertools.combinations(range(len(rows)), 2) if linked(rows[i], rows[j])]
    for i, j in edges:
        links[i] += 1
        links[j] += 1
    low = lambda i: (rows[i][0] is not None, rows[i][0] or 0)
    for _ in rows:
        for i, j in edges:
            root[i] = root[j] = min(root[i], root[j], key=low)
    want = sorted(((r[0], links[i], rows[root[i]][0]) for i, r in enumerate(rows)), key=str)
    got = neighbours.link_vectors(df).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str) == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert neighbours.link_vectors(df.limit(0)).collect() == []


def clustered(draw, sizes, alone, dim=16):
    """Unit vectors in clusters, and the links of each by brute force."""
    rows = [base + draw.normal(size=dim) * 0.12 for n in sizes for base in [draw.normal(size=dim)] for _ in range(n)]
    x = np.array(rows + [draw.normal(size=dim) for _ in range(alone)])
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = x @ x.T >= 0.93
    np.fill_diagonal(near, False)
    return x, near


def vector_table(spark, x):
    return spark.createDataFrame([(i, [float(c) for c in v], 0) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")


def test_start_tables_follow_the_bits(spark):
    side = 1 - np.arccos(0.93) / np.pi
    bits = np.array([1, 7, 10, 14, 17])
    missed = (1 - side**bits) ** neighbours.table_counts(bits, 0.93)
    assert (missed <= 0.001).all()


def no_lists(spark):
    return spark.createDataFrame([], "node long, other long, cosine double")


def test_rare_links_need_no_comparison_of_all(spark, monkeypatch):
    """A few linked pairs among many vectors, fewer than an audit would like to see."""
    monkeypatch.setattr(neighbours, "MOST_AUDIT", 600)
    monkeypatch.setattr(neighbours, "compared_as_a_whole", None)
    draw = np.random.default_rng(17)
    x = draw.normal(size=(4000, 24))
    for i in range(0, 60, 2):
        x[i + 1] = x[i] + draw.normal(size=24) * 0.15
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    near = np.argwhere(np.triu(unit @ unit.T >= 0.93, 1)).tolist()
    rows = [(i, [float(c) for c in v], "a") for i, v in enumerate(x)]
    got = neighbours.link_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")).collect()
    assert {tuple(p) for p in near} == {(r.component_id, r.vec_id) for r in got if not r.kept} and len(near) >= 25
    assert sum(r.n_links for r in got) == 2 * len(near)


def test_an_audit_counts_each_vector(spark):
    x, near = clustered(np.random.default_rng(5), [150] + [2] * 60, 0)
    df = vector_table(spark, x).selectExpr("vec_id AS node", "0L AS g", "embedding AS v")
    vectors = neighbours.unit_vectors(df.selectExpr("node", "1 AS label", "v")).cache()
    pairs = [(int(i), int(j)) for i, j in np.argwhere(near)]
    assert neighbours.audit(vectors, spark.createDataFrame(pairs, "node long, other long"), no_lists(spark), 0.93)
    crowd = [(i, j) for i, j in pairs if i < 150 and j < 150]
    assert len(crowd) >= 0.99 * len(pairs) and len(crowd) < len(pairs)
    assert not neighbours.audit(vectors, spark.createDataFrame(crowd, "node long, other long"), no_lists(spark), 0.93)


def test_all_pairs_are_compared_when_the_audit_fails(spark, monkeypatch):
    x, near = clustered(np.random.default_rng(6), [90, 30, 2, 2, 2], 200)
    monkeypatch.setattr(neighbours, "audit", lambda *_: False)
    monkeypatch.setattr(neighbours, "DESCENTS", 1)
    monkeypatch.setattr(neighbours, "ROUNDS", 0)
    monkeypatch.setattr(neighbours, "BLOCK", 64 * 16)  # several blocks
    got = {r.vec_id: (r.n_links, r.component_id) for r in neighbours.link_vectors(vector_table(spark, x)).collect()}
    least = np.arange(len(x))
    for _ in x:
        least = np.minimum(least, np.where(near, least[None, :], len(x)).min(axis=1))
    assert got == {i: (int(near[i].sum()), int(least[i])) for i in range(len(x))}


def test_a_crowd_is_compared_as_a_whole(spark, monkeypatch):
    """Lists that are saturated when the rounds end, and an audit that sees nothing."""
    x, near = clustered(np.random.default_rng(7), [260, 2, 2], 30)
    monkeypatch.setattr(neighbours, "audit", lambda *_: True)
    monkeypatch.setattr(neighbours, "ROUNDS", 1)
    monkeypatch.setattr(neighbours, "DESCENTS", 1)
    got = {r.vec_id: r.n_links for r in neighbours.link_vectors(vector_table(spark, x)).collect()}
    assert got == {i: int(near[i].sum()) for i in range(len(x))} and near.sum(axis=1).max() > 200


@tables
@pytest.mark.parametrize("name", list(ORACLES))
def test_sql(spark, name):
    assert compare(spark, oracle(SF_DIR), name, SF_DIR) is None


@tables
def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = corpus_pipeline.run(spark, SF_DIR)
    assert out.columns == [*docs.columns, "shard", "slot"]
    rows = out.collect()
    for s in range(corpus_pipeline.SHARDS):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    assert len({r.doc_id for r in rows}) <= docs.count() and max(sum(1 for _ in g) for _, g in itertools.groupby(sorted(r.doc_id for r in rows))) <= 2


def test_registry():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES if n != "pipeline") == list(range(1, 14))


def test_url_query_joins_common_forms(spark, tmp_path):
    """``op2_url_rules`` carries a block from a url to the other urls of its common form."""
    pages = [(1, "http://m.x.test/de/", '<link rel="canonical" href="http://example.com/de/x">'), (2, "http://x.test/de?utm_source=a", None), (3, "http://y.test/", None)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: (r.verdict, r.alias_id) for r in QUERIES["op2_url_rules"](spark, str(tmp_path)).collect()}
    assert got == {1: ("block", "example.com/de/x"), 2: ("block", "example.com/de/x"), 3: ("allow", "y.test")}
