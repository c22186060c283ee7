"""Top-k search against SQL, and URL verdicts against a plain version."""

from __future__ import annotations

import math
import random

import compare
import numpy as np
from pyspark.sql import functions as F

from promolens.llm import queries, urls, vectors

SCHEMA = "vec_id long, embedding array<double>, rank string, score string, v string, dim int"


def best(rows, k=20, every=20):
    """Brute force over (vec_id, embedding)."""
    good: dict[int, list[int]] = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        v = [math.floor(64 * x) for x in v]
        good[i] = min(good.get(i, v), v)
    out = set()
    for q in (i for i in good if i % every == 0):
        scores = [
            (-sum(a * b for a, b in zip(good[q], v)), i)
            for i, v in good.items()
            if i != q and len(v) == len(good[q])
        ]
        out |= {(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k], 1)}
    return out


def test_search_in_small_cells(spark, monkeypatch):
    monkeypatch.setattr(vectors, "QUERIES", 3)
    monkeypatch.setattr(vectors, "CANDIDATES", 40)
    monkeypatch.setattr(vectors, "STEP", 7)
    draw = np.random.default_rng(10)
    centres = draw.normal(size=(4, 6))
    made = [(i, (centres[i % 4] * draw.exponential() + draw.normal(size=6) / 9).tolist()) for i in range(300)]
    made += [(1000 + i, made[0][1]) for i in range(60)]  # ties
    made += [(20, made[1][1]), (20, made[1][1]), (None, made[1][1]), (1, None), (40, [None] * 6)]
    made += [(60, [math.nan] * 6), (80, [math.inf] * 6), (2000, [1.0, 2.0]), (2001, [3.0, 1.0]), (2020, [])]
    made += [(3000, [0.0] * 6), (3020, [-1e6] * 6)]
    df = spark.createDataFrame([(*r, "x", "x", "x", 1) for r in made], SCHEMA)
    found = {tuple(r) for r in vectors.top_k(df).collect()}
    assert found == best(made)
    assert {tuple(r) for r in vectors.top_k(df, 7, 3).collect()} == best(made, 3, 7)
    assert vectors.top_k(df.where("false")).count() == 0


def test_most_pairs_of_clustered_vectors_are_pruned():
    draw = np.random.default_rng(11)
    scale = np.concatenate([np.full(4, 500.0), np.full(28, 5.0)])
    data = np.floor(draw.normal(size=(3000, 32)) * scale).astype(np.int64)
    seen = []
    plain = vectors._scores

    def counted(q, c):
        seen.append(len(q) * len(c))
        return plain(q, c)

    vectors._scores = counted
    try:
        vectors.best_of_cell(np.arange(5), data[:5], np.arange(3000), data, 10)
    finally:
        vectors._scores = plain
    assert sum(seen) < 5 * 3000 / 2


def test_op7_rules(spark, sf_dir):
    con = compare.connect(sf_dir)
    found = queries.op7_urls(spark, sf_dir).select("page_id", "host", "path", "rule")
    sql = r"""
    WITH cut AS (
      SELECT page_id, coalesce(lower(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's')), '') AS host,
        coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path FROM pages
    ), rules AS (SELECT unnest(['org/', 'example.org/es/', 'example.org/en/1', 'com/fr/', 'com/de/']) AS rule)
    SELECT page_id, host, path, (
      SELECT rule FROM rules
      WHERE (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1)))
        AND starts_with(path, substr(rule, strpos(rule, '/')))
      ORDER BY length(rule) DESC LIMIT 1) AS rule
    FROM cut"""
    assert compare.differences(compare.spark_result(found), compare.sql_result(con, sql)) == []


def pages(spark, rows):
    return spark.createDataFrame(
        [(i, u, "x", "x", "x") for i, u in rows], "page_id long, url string, host string, path string, share string"
    )


def test_urls_of_odd_rows(spark):
    rows = [
        (1, "HTTP://A.Example.ORG/es/1?x#y"), (2, None), (3, ""), (4, "no scheme/at/all"), (5, "://"),
        (6, "http://org"), (7, "http://org/"), (8, "http://x.com/fr/://y"), (9, "http://É.com/de/#a?b"),
        (10, "http://notorg/"), (10, "http://notorg/"), (None, "http://h/" + "a/" * 300), (12, "http://h\n/a\nb"),
    ]
    found = {r.page_id: r for r in urls.judge(pages(spark, rows), queries.RULES).collect()}
    assert (found[1].host, found[1].path, found[1].rule, found[1].verdict) == (
        "a.example.org", "/es/1", "example.org/es/", "block",
    )
    assert [(found[i].host, found[i].path) for i in (2, 3, 4, 5)] == [("", "")] * 4
    assert found[6].rule is None and found[7].rule == "org/" and found[10].rule is None
    assert (found[8].path, found[9].host, found[9].rule) == ("/fr/://y", "É.com", "com/de/")
    assert urls.judge(pages(spark, rows), queries.RULES).count() == len(rows)
    assert urls.judge(pages(spark, rows[:0]), queries.RULES).count() == 0
    assert {r.verdict for r in urls.judge(pages(spark, rows), []).collect()} == {"block"}


def test_templates_learn_from_labelled_paths(spark):
    draw = random.Random(12)
    rules = [("bad.com/a/", "block"), ("bad.com/b/", "block"), ("bad.com/c/", "allow")]
    rows = [(k, f"http://bad.com/{'abc'[k % 3]}/{draw.randrange(10**6)}.html") for k in range(300)]
    rows += [(1000 + k, f"http://bad.com/d/slug{k}/{k}") for k in range(100)]
    rows += [(2000 + k, f"http://good.com/d/{k}") for k in range(10)]
    found = {r.page_id: r for r in urls.judge(pages(spark, rows), rules).collect()}
    assert found[0].template == found[1].template == "/a/{n}.html" and found[2].template == "/c/{n}.html"
    assert found[0].share > 0.9 > 0.2 > found[2].share
    # Slugs are generalised, and a branch without labels has its parent's share.
    assert {found[1000 + k].template for k in range(100)} == {"/d/*/{n}"}
    assert found[1000].verdict == "block" and abs(found[1000].share - (200 + 4 * 201 / 302) / 304) < 1e-12
    assert found[2000].share == (0 + 4 * 201 / 302) / 4


def test_labelled_branches_differ_among_many_sections_and_deep_down(spark):
    at = {"x.com": "", "y.com": "a/b/c/d/e/"}  # the split is at the first and at the sixth segment
    rules = [(f"{h}/{p}e/bad/", "block") for h, p in at.items()]
    rules += [(f"{h}/{p}f/good/", "allow") for h, p in at.items()]
    urls_of = [f"{h}/{p}{s}/w{k}" for h, p in at.items() for s in ("e/bad", "f/good") for k in range(30)]
    urls_of += [f"{h}/{p}{s}/zzz" for h, p in at.items() for s in "ef"]
    urls_of += [f"x.com/section{k}/w" for k in range(40)]
    found = urls.judge(pages(spark, [(k, f"http://{u}") for k, u in enumerate(urls_of)]), rules)
    found = {r.host + r.path: (r.verdict, r.template) for r in found.collect()}
    for h, p in at.items():
        assert found[f"{h}/{p}e/zzz"][0] == "block" and found[f"{h}/{p}f/zzz"][0] == "allow"
    assert {found[f"x.com/section{k}/w"][1] for k in range(40)} == {"/*/w"}


def plain_templates(paths):
    """{(host, path): (labelled, blocked)} -> {(host, path): (template, share)}, level by level."""
    w = urls.WEIGHT
    l, b = (sum(v[k] for v in paths.values()) for k in (0, 1))
    of_all = (b + 1) / (l + 2)
    out = {}
    open_ = []
    for host in {h for h, _ in paths}:
        rows = [(p, p.removeprefix("/").split("/"), v) for (h, p), v in paths.items() if h == host]
        l, b = (sum(v[k] for *_, v in rows) for k in (0, 1))
        open_.append((host, "", (b + w * of_all) / (l + w), rows))
    while open_:
        host, template, share, rows = open_.pop()
        children = {}
        for path, left, v in rows:
            if left:
                children.setdefault(left[0], []).append((path, left[1:], v))
            else:
                out[host, path] = (template, share)
        sums = {s: tuple(sum(v[k] for *_, v in r) for k in (0, 1)) for s, r in children.items()}
        rates = {}
        for s, (l, b) in sums.items():
            if l:
                rates.setdefault(b / l, []).append((s, l, b))
        groups, before = [], None
        for rate, same in sorted(rates.items()):
            _, l, b = min(same)
            if before is not None:
                _, l0, b0 = before
                pooled = (b + b0 + 1) / (l + l0 + 2)
                error = math.sqrt(pooled * (1 - pooled) * (1 / l + 1 / l0))
            if before is None or rate - b0 / l0 > urls.SIMILAR * error:
                groups.append([])
            groups[-1] += same
            before = max(same)
        branches = {}
        for same in groups:
            l, b = (sum(x[k] for x in same) for k in (1, 2))
            name = min(min(x for x in same if x[2] / x[1] == r)[0] for r in {x[2] / x[1] for x in same})
            branches[name] = (b + w * share) / (l + w), [r for x in same for r in children[x[0]]]
        for s, r in children.items():
            if not sums[s][0]:
                name = "*" if len(children) > urls.CHILDREN else s
                at = branches.setdefault(name, (share, []))
                at[1].extend(r)
        open_ += [(host, f"{template}/{name}", *found) for name, found in branches.items()]
    return out


def check_templates(spark, paths):
    df = spark.createDataFrame(
        [(h, p, *v) for (h, p), v in paths.items()], "host string, path string, labelled long, blocked long"
    )
    found = {(r.host, r.path): (r.template, r.share) for r in urls.templates(df).collect()}
    expected = plain_templates(paths)
    assert set(found) == set(expected)
    for at, (template, share) in expected.items():
        assert found[at][0] == template and math.isclose(found[at][1], share, rel_tol=1e-9), at


def test_random_trees_are_those_of_a_plain_version(spark):
    draw = random.Random(21)
    paths = {}
    for _ in range(700):
        depth = draw.choice([0, 1, 2, 2, 3, 5, 9])
        segments = [draw.choice("abc" if k < 2 else "xyzuvw") * draw.randint(1, 2) for k in range(depth)]
        segments += ["tail", "of", "all"][: draw.choice([0, 0, 3])]
        l = draw.choice([0, 0, 1, 3, 40])
        paths[draw.choice(["h", "g.org"]), "/" + "/".join(segments)] = (l, draw.choice([0, l, l // 2]))
    paths |= {("many", f"/s/c{k}/e"): (0, 0) for k in range(40)}
    paths |= {("many", "/s/known/e"): (5, 5), ("", ""): (0, 0)}
    check_templates(spark, paths)


def test_templates_of_the_pages(spark, sf_dir):
    found = queries.op7_urls(spark, sf_dir).collect()
    parsed = spark.read.parquet(f"{sf_dir}/pages.parquet").select(
        "page_id", urls.generalised(urls.path(F.col("url"))).alias("p")
    )
    general = {r.page_id: r.p for r in parsed.collect()}
    paths = {}
    for r in found:
        l, b = paths.get((r.host, general[r.page_id]), (0, 0))
        ruled = r.rule is not None
        paths[r.host, general[r.page_id]] = (l + ruled, b + (ruled and r.verdict == "block"))
    expected = plain_templates(paths)
    for r in found:
        template, share = expected[r.host, general[r.page_id]]
        assert r.template == template and math.isclose(r.share, share, rel_tol=1e-9)
        if r.rule is None:
            assert r.verdict == ("block" if share >= urls.REJECT else "allow")


def test_long_common_paths_take_one_round(spark, monkeypatch):
    rounds = []
    monkeypatch.setattr(urls, "stored", lambda df, of=urls.stored: rounds.append(1) or of(df))
    long = "/".join(f"s{k}" for k in range(1000))
    check_templates(spark, {("h", f"/{long}/{end}"): (k, k % 2) for k, end in enumerate(("a", "b", "c/d"))})
    assert len(rounds) <= 5


def test_generalised_paths(spark):
    df = spark.createDataFrame(
        [("/en/12/x9.html",), ("/2024/01.html",), ("/9f86d081884c7d659a2feaa0c55ad015/",), ("",), ("/1/2",),
         ("/x" + "/ab" * 70 + "/abc",), ("/q" + "/m/n" * 9,), ("/a/a/b/b",)], "p string"
    )
    assert [r[0] for r in df.select(urls.generalised(F.col("p"))).collect()] == [
        "/en/{n}/x9.html", "/{n}/{n}.html", "/{x}/", "", "/{n}/{n}",
        "/x/ab/{r}/abc", "/q/m/n/{r}", "/a/a/b/b",
    ]
