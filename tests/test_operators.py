"""The operators' particular rules, on literal rows."""

import math
import random
import re
import statistics
from collections import Counter

import pytest
from pyspark.sql import functions as F

from locusframe import calls as C
from locusframe import clades as T
from locusframe import distance as D
from locusframe import graph as G
from locusframe import intervals as I
from locusframe import qc as Q
from locusframe import sites as S
from locusframe import sketch as K
from locusframe import sources as IO
from locusframe import spacing as W
from locusframe import stripes as P
from locusframe.along import neighbours
from locusframe.quantiles import Quantile, median, quantiles


def sites(spark, *pos, contig="c"):
    return spark.createDataFrame([(contig, p) for p in pos], "contig string, pos long")


def kept(df):
    return sorted(r.pos for r in df.collect())


def test_frequencies_are_rounded_before_thresholds(spark):
    rows = spark.createDataFrame([("c", 1, "s", "A", "T", 1000, 1000, 746, 254), ("c", 2, "s", "A", "T", 0, 0, 0, 0)], "contig string, pos long, sample string, ref string, alt string, dp int, adp int, ad int, rd int")
    got = {r.pos: r for r in C.classify(C.frequencies(rows)).collect()}
    assert (got[1].af, got[1].ft, got[1].gt) == (0.75, "PASS", "1/1")
    assert (got[2].af, got[2].ft, got[2].gt) == (0.0, "DP10;AF0.75", "./.")
    swapped = {r.pos: r.ft for r in C.classify(C.frequencies(rows), swap_labels=True).collect()}
    assert swapped[2] == "DP10;RF0.75"


def test_consensus_prefers_the_reference_then_the_smaller_letter(spark):
    rows = [("c", 1, "s", "T", b) for b in "TA"] + [("c", 2, "s", "T", b) for b in "GCC G".replace(" ", "")]
    got = {r.pos: (r.alt, r.ad, r.rd, r.dp) for r in C.consensus(spark.createDataFrame(rows, "contig string, pos long, sample string, ref string, base string")).collect()}
    assert got == {1: (".", 0, 1, 2), 2: ("C", 2, 0, 4)}


def test_haploid_and_ambiguity(spark):
    df = spark.createDataFrame([("A/A", ["A"]), ("A/T", ["A", "T"]), ("./.", ["a", "C", "G", "T"]), ("AT/AT", ["Q"]), ("G|G", [])], "gt string, l array<string>")
    got = df.select(C.haploid_of(F.col("gt")).alias("h"), C.ambiguity(F.col("l")).alias("a")).collect()
    assert [(r.h, r.a) for r in got] == [("A", "A"), ("N", "W"), ("N", "N"), ("N", "N"), ("G", "N")]


def test_density_filter_rules(spark):
    r = random.Random(3)
    pos = sorted(r.sample(range(1, 9000), 120))
    for k, window in ((2, 158), (3, 184)):
        got = kept(W.density_filter(sites(spark, *pos), k, window))
        body = [p for p in got if p in pos[:-k]]
        assert all(pos[pos.index(p) + k - 1] - p >= window for p in body)
        assert (pos[-1] in got) == (pos[-1] - pos[-k - 1] >= window)
    assert kept(W.density_filter(sites(spark, 1, 2, 3), 1, 100)) == [1, 2, 3]
    assert kept(W.density_filter(sites(spark, 1, 2), 2, 100)) == [1, 2]


def test_gap_filters_differ_in_the_first_site_and_ties(spark):
    df = sites(spark, 10, 20, 25, 35)
    assert kept(W.far_from_previous(df, 10)) == [10]
    assert kept(W.least_gap(df, 10)) == [10, 20, 35]
    assert kept(W.least_gap(df, 10, first=False)) == [20, 35]


def test_thinning_is_greedy(spark, monkeypatch):
    r = random.Random(1)
    for fan in (256, 3):
        monkeypatch.setattr(W, "FAN", fan)
        pos = sorted({*r.sample(range(-300, 2000), 150), *r.sample(range(9000, 9100), 20), 20_000})
        want, last = [], None
        for p in pos:
            if last is None or p - last >= 17:
                want.append(p)
                last = p
        df = sites(spark, *pos).unionByName(sites(spark, 5, 6, 40, contig=None))
        for width in (None, 17, 40, 700):
            got = W.thin(df, 17, width=width).collect()
            assert sorted(x.pos for x in got if x.contig == "c") == want, (fan, width)
            assert sorted(x.pos for x in got if x.contig is None) == [5, 40]
    assert W.thin(sites(spark, 1).filter("pos > 1"), 17).count() == 0


def test_neighbours_across_bins(spark):
    r = random.Random(2)
    pos = sorted(r.sample(range(500), 60)) + [499, 499]
    rows = [("c", p) for p in pos] + [(None, 7), (None, 3)]
    df = spark.createDataFrame(rows, "contig string, pos long")
    for width in (1, 13, 10_000):
        got = neighbours(df, width=width).collect()
        mine = sorted((x._i, x.pos, x._prev, x._next, x._total) for x in got if x.contig == "c")
        assert [x[0] for x in mine] == list(range(62)) and [x[1] for x in mine] == sorted(pos) and {x[4] for x in mine} == {62}
        assert [x[2] for x in mine] == [None, *sorted(pos)[:-1]] and [x[3] for x in mine] == [*sorted(pos)[1:], None]
        assert sorted((x.pos, x._prev, x._next) for x in got if x.contig is None) == [(3, None, 7), (7, 3, None)]
    intervals = [("c", a, a + r.randint(0, 30)) for a in r.sample(range(400), 40)]
    want = []
    for _, lo, hi in sorted(intervals):
        if want and lo <= want[-1][1] + 3:
            want[-1][1] = max(want[-1][1], hi)
        else:
            want.append([lo, hi])
    table = spark.createDataFrame(intervals, "contig string, lo long, hi long")
    for size in (1, 7, 1000):
        assert sorted([x.lo, x.hi] for x in I.union(table, 3, size).collect()) == want


def test_intervals(spark):
    df = spark.createDataFrame([("c", 1, 5), ("c", 6, 9), ("c", 11, 12), ("c", 2, 3), ("d", 4, 4)], "contig string, lo long, hi long")
    rows = lambda x: sorted((r.contig, r.lo, r.hi) for r in x.collect())
    assert rows(I.union(df)) == rows(I.union(df, bin_size=4)) == [("c", 1, 9), ("c", 11, 12), ("d", 4, 4)]
    extents = spark.createDataFrame([("c", 12), ("d", 9), ("e", 3), ("f", 4)], "contig string, len long")
    assert rows(I.complement(df, extents)) == [("c", 10, 10), ("d", 1, 3), ("d", 5, 9), ("e", 1, 3), ("f", 1, 4)]
    assert rows(I.complement(df, extents, last_base=False)) == [("c", 10, 10), ("d", 1, 3), ("d", 5, 8), ("e", 1, 2), ("f", 1, 3)]
    assert rows(I.soft_merge(df, 1)) == [("c", 1, 12), ("d", 4, 4)]
    assert rows(I.tiles(spark.createDataFrame([("c", 1), ("d", 25)], "contig string, len long"), 10, 2)) == [("c", 1, 1), ("d", 1, 12), ("d", 11, 22), ("d", 21, 25)]
    points = sites(spark, 1, 5, 9, 10, 11, 13)
    for few in (True, False):
        assert kept(I.inside(points, df, bin_size=3, few=few)) == [1, 5, 9, 11]
        assert kept(I.outside(points, df, bin_size=3, few=few)) == [10, 13]
        assert sorted((r.pos, r.masked) for r in I.flagged(points, df, bin_size=3, few=few).collect()) == [(1, True), (5, True), (9, True), (10, False), (11, True), (13, False)]


def test_intervals_of_all_widths(spark):
    r = random.Random(14)
    spans, at = [], 0
    for _ in range(60):
        at += r.randint(2, 50)
        spans.append(("c", at, at + r.choice([0, 3, 40, 700, 10_000, 10**6])))
        at = spans[-1][2]
    spans += [("big", -5, 10**9 - 6), ("huge", 0, 10**15), ("one", 7, 7)]
    df = spark.createDataFrame(spans, "contig string, lo long, hi long")
    rows = I.nested(I.union(df), 10_000)
    assert {x.contig: x.n for x in rows.groupBy("contig").agg(F.count(F.lit(1)).alias("n")).collect()}["big"] <= 2 and rows.count() <= 2 * len(spans)
    points = [("c", p, 0) for p in range(0, at, 997)] + [("c", p + k, 1) for _, lo, hi in spans[:60] for p in (lo, hi) for k in (-1, 0, 1)] + [("c", spans[0][1], 1)] * 3
    points += [(c, p, 2) for c in ("big", "huge", "one", "none", None) for p in (-6, -5, 0, 7, 10**9 - 6, 10**9, 10**15 + 1)]
    want = sorted(((c, p, v, any(c == i and lo <= p <= hi for i, lo, hi in spans)) for c, p, v in points), key=str)
    table = spark.createDataFrame(points, "contig string, pos long, bin int")
    for size in (4, 10_000):
        assert sorted(map(tuple, I.flagged(table, df, bin_size=size, few=False).collect()), key=str) == want
    assert I.inside(table, df, few=False).count() == sum(x[3] for x in want) and I.outside(table, df, few=False).count() == sum(not x[3] for x in want)
    assert I.outside(table, df.filter("lo < 0 and lo > 0"), few=False).count() == len(points)


def genotypes(spark, **samples):
    n = len(next(iter(samples.values())))
    return spark.createDataFrame([("c", p + 1, "A", s, v[p]) for s, v in samples.items() for p in range(n)], "contig string, pos long, ref string, sample string, nt string")


def test_stripes_hold_no_more_than_their_width(spark, tmp_path):
    r = random.Random(5)
    seqs = {f"s {i}": "".join(r.choice("ACGTN") for _ in range(103)) for i in range(4)}
    df = genotypes(spark, **seqs).repartition(7)
    pieces = P.stripes(df, 10)
    assert {x.n for x in pieces.select(F.char_length("seq").alias("n")).collect()} == {10, 3}
    P.write_stripes(pieces, f"{tmp_path}/s")
    back = P.read_stripes(spark, f"{tmp_path}/s")
    assert {s: "".join(x.seq for x in sorted(back.filter(F.col("sample") == s).collect(), key=lambda x: x.offset)) for s in seqs} == seqs
    assert {(x["sample"], x.number): x.nt for x in P.opened(back).collect()} == {(s, i): c for s, v in seqs.items() for i, c in enumerate(v)}
    lines = P.transposed_stripes(df, 50).filter("sample = '.'").orderBy("offset").collect()
    assert "\t".join(x.seq for x in lines).split("\t") == [f"c:{i + 1}" for i in range(103)] and [x.offset for x in lines] == [0, 50, 100]
    blocks = {(0, "a"): "ACGTA", (0, "b"): "CCCCC", (1, "b"): "T", (2, "a"): "GGGGGGGGGGGG"}
    pieces = P.cut(spark.createDataFrame([(k, s, v) for (k, s), v in blocks.items()], "block int, sample string, seq string"), 4)
    for linker in ("", "NN"):
        out = P.concatenated(pieces, linker, 5).orderBy("sample", "offset").collect()
        assert max(len(x.seq) for x in out) <= 5
        for s in "ab":
            mine = [x for x in out if x["sample"] == s]
            assert "".join(x.seq for x in mine) == linker.join(blocks.get((k, s), "-" * n) for k, n in enumerate((5, 1, 12)))
            assert [x.offset for x in mine] == [sum(len(y.seq) for y in mine[:i]) for i in range(len(mine))]
    assert P.concatenated(pieces.filter("block > 7"), "NN").count() == 0
    assert P.stripes(spark.createDataFrame([], df.schema)).count() == 0


def test_three_filters_treat_n_differently(spark):
    df = genotypes(spark, a="AANAT-", b="ANNTTA")
    pos = lambda x: sorted({r.pos for r in x.collect()})
    assert pos(S.site_filter(df, ambiguities=True)) == [2, 4, 6]
    assert pos(S.site_filter(df, ambiguities=True, ns_as_ref=True)) == [4, 6]
    assert pos(S.site_filter(df)) == [4]
    columns = df.select("sample", "pos", "nt")
    assert pos(S.informative_columns(columns, ambiguities=True, gaps=True)) == [4, 6]
    assert pos(S.informative_sites(df, ambiguities=True, gaps=True)) == [2, 4, 6]
    assert pos(S.strict_columns(columns)) == [4]


def test_distances(spark):
    r = random.Random(4)
    seqs = {f"s{i}": "".join(r.choice("ACGTNacgt-") for _ in range(70)) for i in range(9)}
    want = {(a, b): sum(x.upper() != y.upper() and x.upper() in "ACGT" and y.upper() in "ACGT" for x, y in zip(seqs[a], seqs[b], strict=True)) for a in seqs for b in seqs if a < b}
    df = genotypes(spark, **seqs)
    assert {(x.a, x.b): x.d for x in D.pairwise(df).collect()} == want
    aln = spark.createDataFrame(list(seqs.items()), "sample string, seq string")
    assert {(x.a, x.b): x.d for x in D.pairwise_packed(aln, blocks=3).collect()} == want
    same = genotypes(spark, a="NN", b="AN")
    assert [(x.a, x.b, x.d) for x in D.pairwise(same).collect()] == [("a", "b", 0)]


def test_square_prints_zero_and_back(spark):
    edges = spark.createDataFrame([("a", "b", 0), ("a", "c", 3), ("b", "c", 4)], "a string, b string, d long")
    m = D.square(edges, ["a", "b", "c"])
    assert sorted(tuple(r) for r in m.collect()) == [("a", "-", "0", "3"), ("b", "0", "-", "4"), ("c", "3", "4", "-")]
    assert sorted(tuple(r) for r in D.square(edges, ["a", "b", "c"], zero_as_dash=True).collect())[0] == ("a", "-", "-", "3")
    assert {(r.a, r.b): r.d for r in D.unsquare(m).collect()} == {("a", "a"): 0, ("a", "b"): 0, ("a", "c"): 3, ("b", "b"): 0, ("b", "c"): 4, ("c", "c"): 0}
    part = D.phylip(edges.filter("d <> 4"))
    assert {r.sample: (r.row, r.complete) for r in part.collect()} == {"a": ("0 0 3", True), "b": ("0 0 ?", False), "c": ("3 ? 0", False)}


def test_graph(spark):
    edges = spark.createDataFrame([(i, i + 1, 1) for i in range(30)] + [(100, 101, 1), (200, 201, 9)], "a long, b long, d long")
    got = {r.node: r.cluster for r in G.clusters(edges, 5).collect()}
    assert got == {**{i: 0 for i in range(31)}, 100: 100, 101: 100}
    chain = spark.createDataFrame([(0, 1, 10), (1, 2, 30), (2, 3, 10)], "a long, b long, d long")
    parts = G.limited_clusters(chain, 30, 2, step=10)
    assert {r.node: r.cluster for r in parts.collect()} == {0: 0, 1: 0, 2: 2, 3: 2}
    stat = G.cluster_statistics(spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "node long, cluster long"), spark.createDataFrame([(1, 2, 0), (1, 3, 5)], "a long, b long, d long"), 10).first()
    assert (stat.mean, stat.spread, stat.least, stat.largest) == (5, 5, 0, 10)
    star = spark.createDataFrame([("hub", x, 1.0) for x in "abcd"], "a string, b string, w double")
    ranks = G.pagerank(star)
    assert G.index_case(ranks).first().node == "hub" and abs(ranks.agg(F.sum("rank")).first()[0] - 1) < 1e-9


def components_of(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {x: find(x) for x in list(root)}


def test_one_dendrogram_for_all_limits(spark):
    r = random.Random(21)
    pairs = {tuple(sorted(r.sample(range(70), 2))): r.choice([3, 10, 14, 20, 21, 33, 40, 47, 60]) for _ in range(110)}
    rows = [(a, b, d) if r.random() < 0.5 else (b, a, d) for (a, b), d in pairs.items()] + [(1, 1, 3), (500, 501, 60), (600, 601, 61)]
    edges = spark.createDataFrame(rows, "a long, b long, d long")
    forest = G.spanning_forest(edges)
    kruskal, joined = [], {}
    for d, a, b in sorted((d, *sorted((a, b))) for a, b, d in rows if a != b):
        before = components_of(kruskal)
        if before.get(a, a) != before.get(b, b):
            kruskal.append((a, b))
            joined[a, b] = d
    assert {(x.a, x.b): x.d for x in forest.collect()} == joined
    levels = sorted({d for *_, d in rows})
    joins = G.dendrogram(forest.withColumn("level", sum((F.when(F.col("d") > x, 1).otherwise(0) for x in levels), F.lit(0))), len(levels)).collect()
    for i, t in enumerate(levels):
        want = components_of([(a, b) for a, b, d in rows if d <= t and a != b])
        got = components_of([(x.node, x.into) for x in joins if x.level <= i])
        assert got == want
    # the limits one after the other
    most, largest, step, floor = 47, 9, 12, 5
    want, rest, at = {}, [x for x in rows if x[2] <= most and x[0] != x[1]], most
    while True:
        found = components_of([(a, b) for a, b, d in rest if d <= at])
        size = Counter(found.values())
        last = at <= floor
        want.update({x: (c, size[c], at) for x, c in found.items() if last or size[c] <= largest})
        if last:
            break
        rest = [(a, b, d) for a, b, d in rest if found.get(a, -1) == found.get(b, -2) and size[found[a]] > largest]
        at = max(floor, at - step)
    assert {x.node: (x.cluster, x.size, x.at) for x in G.limited_clusters(edges, most, largest, step, floor).collect()} == want
    assert G.limited_clusters(edges.filter("d > 100"), most, largest).count() == 0


def test_ranks_with_hubs_and_arcs_that_stay(spark, monkeypatch):
    r = random.Random(8)
    pairs = {tuple(sorted(r.sample(range(40), 2))) for _ in range(60)} | {(0, i) for i in range(1, 40)}
    rows = [(a, b, r.random() + 0.1) for a, b in pairs]
    out, rank = {}, dict.fromkeys(range(40), 1 / 40)
    for a, b, w in rows:
        out.setdefault(a, []).append((b, w))
        out.setdefault(b, []).append((a, w))
    for _ in range(4):
        new = dict.fromkeys(range(40), 0.15 / 40)
        for a, arcs in out.items():
            for b, w in arcs:
                new[b] += 0.85 * rank[a] * w / sum(x for _, x in arcs)
        rank = new
    weighted = spark.createDataFrame(rows, "a long, b long, w double")
    for hub in (100_000, 7):
        monkeypatch.setattr(G, "HUB", hub)
        got = {x.node: x.rank for x in G.pagerank(weighted, rounds=4, every=3).collect()}
        assert set(got) == set(rank) and all(math.isclose(got[x], rank[x], rel_tol=1e-9) for x in rank)
    assert G.pagerank(weighted.filter("a < 0")).count() == 0
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        arcs = spark.range(50).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"), F.rand(1).alias("p"), F.pmod(F.col("id"), F.lit(2)).cast("int").alias("part")).repartition(4, "a", "part").persist()
        arcs.count()
        sent = G._sent(arcs, spark.range(50).select(F.col("id").alias("node"), F.lit(1.0).alias("rank")), spark.createDataFrame([], "hub long, parts int"))
        plan = sent._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and all("REPARTITION_BY_NUM" in line for line in plan.splitlines() if re.search(r"Exchange hashpartitioning\(a#", line))
        arcs.unpersist()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_clades(spark):
    rows = [("r", None, None), ("x", "r", None), ("y", "x", None), ("l1", "y", "1"), ("l2", "y", "2"), ("l3", "x", "3"), ("l4", "r", "4")]
    tree = spark.createDataFrame([(n, p, 90.0, 1.0, leaf) for n, p, leaf in rows], "node_id string, parent_id string, bootstrap double, branch_length double, leaf_id string")
    sets = T.leaf_sets(tree)
    got = {}
    for r in sets.collect():
        got.setdefault(r.node_id, set()).add(r.leaf_id)
    assert got == {"r": {"1", "2", "3", "4"}, "x": {"1", "2", "3"}, "y": {"1", "2"}}
    assert {(r.node_id, r.leaf_id) for r in T.clades(tree).outside().collect()} == {("x", "4"), ("y", "3"), ("y", "4")}

    def letters(k):
        return letters((k - 1) // 26) + chr(65 + (k - 1) % 26) if k else ""

    ks = [1, 26, 27, 52, 53, 702, 703, 18_278, 18_279, 20_000, 475_254, 475_255, 10**12]
    labels = spark.createDataFrame([(k,) for k in ks], "k long").select("k", T.label(F.col("k")).alias("l")).collect()
    assert [r.l for r in labels] == [letters(r.k) for r in labels] and letters(703) == "AAA" and letters(18_279) == "AAAA"
    d = spark.createDataFrame([("g", v) for v in (1, 2, 9)], "g string, d long")
    assert tuple(T.spread(d, "g").first()) == ("g", 2, 1, 9, 1)


def test_spine_and_cliffs(spark):
    depth = spark.createDataFrame([("c", p, 10 if p < 20 else 10 + 8 * (p - 19)) for p in range(1, 35)], "contig string, pos long, depth int")
    extents = spark.createDataFrame([("c", 60), ("d", 3)], "contig string, len long")
    dense = W.spine(depth, extents)
    assert dense.count() == 63 and dense.filter("depth = 0").count() == 29
    found = [(r.contig, r.lo, r.hi) for r in W.cliffs(dense).collect()]
    assert len(found) >= 1 and found[0][0] == "c" and found[0][1] >= 10


def test_files(spark, tmp_path):
    text = "##head\n#CHROM\nc\t5\t.\tA\tAT\t.\tPASS\tdp=3;x=1\tGT:AD\t1/1:3\nc\t6\t.\tA\t*\t.\tDP10\tdp=2\tGT:AD\t./.:0\n"
    (tmp_path / "s1-reference.vcf").write_text(text)
    rows = sorted(IO.unpack(IO.read_calls(spark, str(tmp_path))).collect(), key=lambda r: r.pos)
    assert [(r["sample"], r.alt, r.ft, r.info["DP"], r.fields["GT"]) for r in rows] == [("s1", "n", "PASS", "3", "1/1"), ("s1", "n", "DP10", "2", "./.")]
    assert IO.clean_header("# [1]CHROM") == "CHROM" and IO.clean_header("[4]s1:GT") == "s1"


def test_reports_and_names(spark):
    names = spark.createDataFrame([("x10y2",), ("X9y10",), ("x9y2",)], "n string").orderBy(Q.natural_key(F.col("n")))
    assert [r.n for r in names.collect()] == ["x9y2", "X9y10", "x10y2"]
    got = Q.mates(spark.createDataFrame([("a_R1_x",), ("a_R2_x",), ("b_1.f",), ("b_1.g",), ("none",)], "name string"))
    assert {r.base: (r.first, r.second, r.n_first) for r in got.collect()} == {"a": ("a_R1_x", "a_R2_x", 1), "b": ("b_1.f", None, 2)}
    seqs = spark.createDataFrame([(1, "GGNNacgt"), (2, "")], "sample long, seq string")
    assert {r["sample"]: (r.n_percent, r.gc_percent) for r in Q.composition(seqs).collect()} == {1: (25.0, 50.0), 2: (None, None)}


def test_kmers_and_motifs(spark):
    seqs = spark.createDataFrame([(1, "abab"), (2, "ab"), (3, "a")], "sample long, seq string")
    assert {(r["sample"], r.kmer): r.n for r in K.kmers(seqs, 2, 1).collect()} == {(1, "ab"): 2, (1, "ba"): 1, (2, "ab"): 1}
    j = K.jaccard(K.kmers(seqs, 2, 1)).first()
    assert (j.a, j.b, j.common, j.total, j.distance) == (1, 2, 1, 2, 0.5)
    spans = K.motif_spans(seqs, [("m", "ab", 1.0)]).orderBy("sample", "start").collect()
    assert [(r.start, r.end, r.error, r.error_start) for r in spans] == [(1, 2, "a", 3), (3, 4, None, None), (1, 2, None, None)]
    spans = K.motif_spans(seqs, [("m", "(b)(a)", 1.0)]).collect()
    assert [(r.start, r.end, r.error, r.error_start, r.error_end) for r in spans] == [(2, 2, "a", 3, 3)]
    many = spark.createDataFrame([(i, f"common {'x' * (i % 5 + 2)} y{i % 9}") for i in range(200)], "sample long, seq string")
    sets = {i: {t[j : j + 3] for j in range(len(t) - 2)} for i, t in ((r["sample"], r.seq) for r in many.collect())}
    got = {(r.a, r.b): (r.common, r.total) for r in K.jaccard(K.kmers(many, 3, 1)).collect()}
    assert got == {(a, b): (len(sets[a] & sets[b]), len(sets[a] | sets[b])) for a in sets for b in sets if a < b}
    assert [r.c for r in spark.createDataFrame([("acgtn",)], "k string").select(K.encoded(F.col("k")).alias("c")).collect()] == ["01234"]


def test_one_scan_finds_what_each_motif_finds(spark):
    r = random.Random(17)
    patterns = ["an+d", "[0-9]{2,}", "the[a-z]", "(io|oi)n", "(aa|a)b?", "^the", "n$", "(?=ab)a", "(?i)AND", ".*x", "a*", "[^a]b", "(?<=t)he", "(an+d)(.)", "(?:ab|abab)+c?", "a{2,3}", "é.", "b(?!a)", "x|yz|"]
    patterns += ["".join(r.choice("abdehnt") for _ in range(r.randint(2, 5))) for _ in range(200)]
    texts = ["".join(r.choice(["a", "b", "n", "d", "the", "io", "n", "12", "é", "\n", "x", "AND", "yz"]) for _ in range(r.randint(0, 200))) for _ in range(60)]
    scanner = K.Scanner(patterns)
    assert len(scanner.alone) < 8
    for t in texts:
        got = {}
        for i, m in scanner.matches(t):
            got.setdefault(i, []).append(m.span())
        want = {i: [m.span() for m in re.finditer(p, t) if m.end() > m.start()] for i, p in enumerate(patterns)}
        assert got == {i: spans for i, spans in want.items() if spans}
    motifs = spark.createDataFrame([(f"m{i}", p) for i, p in enumerate(patterns)], "name string, pattern string")
    rows = spark.createDataFrame([*enumerate(texts), (None, "and"), (7, None)], "sample long, seq string")
    counted = sorted((str(x["sample"]), x.name, x.n) for x in K.motif_counts(rows, motifs).collect())
    want = [(str(s), f"m{i}", n) for s, t in [*enumerate(texts), (None, "and")] for i, p in enumerate(patterns) if (n := sum(m.end() > m.start() for m in re.finditer(p, t)))]
    assert counted == sorted(want)


def test_distinct_reads(spark):
    rows = [("x", 3, "AC", "p"), ("x", 1, "AC", "q"), ("x", 2, None, "r"), ("x", 4, "", "r"), ("y", 9, "AC", None), ("y", 9, "AC", "a"), (None, 5, "AC", "n"), (None, 6, "AC", "n")]
    reads = spark.createDataFrame(rows, "sample string, id long, seq string, least string")
    got = K.without_duplicates(reads, F.col("id"))
    assert got.columns == reads.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted([rows[1], rows[2], rows[4], rows[6]], key=str)


def test_kmers_of_long_texts(spark, monkeypatch):
    r = random.Random(9)
    texts = ["".join(r.choice("abé日\U0001f600\n") for _ in range(n)) for n in (0, 3, 4, 127, 128, 131, 132, 256, 259, 260, 1000)]
    # samples of several sequences, a null one, and alphabets too large for 64 bits a k-mer
    rows = list(enumerate(texts)) + [(3, "abababab"), (None, "abab"), (None, "abab"), (50, "".join(chr(r.randint(32, 0x2FFF)) for _ in range(3000)) * 2), (51, None)]

    def counted(k, least):
        want = {}
        for i, t in rows:
            for j in range(len(t or "") - k + 1):
                want[i, t[j : j + k]] = want.get((i, t[j : j + k]), 0) + 1
        return {key: n for key, n in want.items() if n >= least}

    df = spark.createDataFrame(rows, "sample long, seq string")
    for chunk in (1 << 20, 300):
        monkeypatch.setattr(K, "CHUNK", chunk)
        for k, least in ((1, 1), (4, 1), (8, 2), (33, 1)):
            got = K.kmers(df, k, least).collect()
            assert {(x["sample"], x.kmer): x.n for x in got} == counted(k, least) and len(got) == len(counted(k, least))


def test_matrix_and_fasta_files(spark, tmp_path):
    wide = spark.createDataFrame([("c", 5, "A", "T", "N"), ("c", 6, "G", "G", "*")], "contig string, pos long, ref string, s1 string, s2 string")
    IO.write_matrix(wide, f"{tmp_path}/m")
    assert "[1]CHROM\t[2]POS\t[3]REF\t[4]s1:GT\t[5]s2:GT" in "".join(x.value + "\n" for x in spark.read.text(f"{tmp_path}/m").collect())
    got = sorted((x.pos, x["sample"], x.nt, x.ref) for x in IO.read_matrix(spark, f"{tmp_path}/m").collect())
    assert got == [(5, "s1", "T", "A"), (5, "s2", "N", "A"), (6, "s1", "G", "G"), (6, "s2", "*", "G")]
    IO.write_fasta(spark.createDataFrame([("s1", "TG"), ("s2", "")], "sample string, seq string"), f"{tmp_path}/f")
    (tmp_path / "f" / "more.txt").write_text(">s3\nAC\nGT\n")
    assert sorted((x["sample"], x.seq) for x in IO.read_fasta(spark, f"{tmp_path}/f").collect()) == [("s1", "TG"), ("s2", ""), ("s3", "ACGT")]


def test_distances_across_sample_blocks(spark):
    r = random.Random(4)
    cells = [("c", p, f"s{i:02d}", r.choice("AACGN")) for p in range(30) for i in range(20)]
    want = {(f"s{i:02d}", f"s{j:02d}"): 0 for i in range(20) for j in range(i + 1, 20)}
    by = {}
    for _, p, x, nt in cells:
        by.setdefault(p, {})[x] = nt
    for row in by.values():
        for a, b in want:
            want[a, b] += row[a] != row[b] and "N" not in (row[a], row[b])
    df = spark.createDataFrame(cells, "contig string, pos long, sample string, nt string")
    for block in (3, 64):
        assert {(x.a, x.b): x.d for x in D.pairwise(df, block=block).collect()} == want


def test_distances_from_deviations_equal_bit_planes(spark):
    r = random.Random(6)
    n, width = 300, 64
    # sites of few carriers, of many, with most samples missing, and with samples that have no row
    kinds = [r.choice(["few", "few", "few", "many", "missing", "none", "same"]) for _ in range(width)]
    letter = {"few": lambda: r.choice("AAAAAAAAAAAAAAAAAAAAAAAAAAAAACGN"), "many": lambda: r.choice("ACGTN"), "missing": lambda: r.choice("ACNNNN-"), "none": lambda: r.choice("N"), "same": lambda: r.choice("GGGN")}
    seqs = {f"s{i:04d}": "".join(letter[k]() for k in kinds) for i in range(n)}
    aln = spark.createDataFrame(list(seqs.items()), "sample string, seq string")
    cells = [("c" if p % 5 else None, p, s, x) for s, v in seqs.items() for p, x in enumerate(v) if x != "-"]
    df = spark.createDataFrame(cells, "contig string, pos long, sample string, nt string")
    want = D.pairwise_packed(aln).withColumnRenamed("d", "e")
    for block in (64, 1000):
        got = D.pairwise(df, block=block)
        both = got.join(want, ["a", "b"], "full")
        assert both.count() == n * (n - 1) // 2 and both.filter("d is null or e is null or d <> e").count() == 0


def tree_of(spark, rows):
    return spark.createDataFrame(rows, "node_id string, parent_id string, leaf_id long")


def test_leaf_intervals_of_random_trees(spark, monkeypatch):
    r = random.Random(12)
    monkeypatch.setattr(T, "GROUP", 3)
    for _ in range(3):
        rows, parent = [("n0", None, None), ("n1", None, None)], {}
        for i in range(2, 60):
            parent[f"n{i}"] = f"n{r.randint(0, i - 1) if r.random() < 0.7 else i - 1}"
            rows.append((f"n{i}", parent[f"n{i}"], None))
        leaves = [(f"v{i}", f"n{r.choice([0, 1, 7, r.randint(0, 59)])}", i) for i in range(90)]
        want = set()
        for _, up, leaf in leaves:
            while up:
                want.add((up, leaf))
                up = parent.get(up)
        mixed = rows + leaves
        r.shuffle(mixed)
        of = T.clades(tree_of(spark, mixed).repartition(5))
        below = [tuple(x) for x in of.below().collect()]
        assert set(below) == want and len(below) == len(want) and of.total == 90
        nodes = {n for n, _ in want}
        assert {tuple(x) for x in of.outside().collect()} == {(n, i) for n in nodes for i in range(90)} - want
        assert sorted(x.number for x in of.leaves.collect()) == list(range(90))


def test_a_caterpillar_takes_few_rounds(spark):
    n = 10_000
    rows = [("n0", None, None)] + [(f"n{i}", f"n{i - 1}", None) for i in range(1, n)] + [(f"v{i}", f"n{i}", i) for i in range(n)]
    of = T.clades(tree_of(spark, rows))
    assert of.rounds < 20 and of.total == n
    got = of.intervals.select((F.col("lo") == F.substring("node_id", 2, 9).cast("long")).alias("from"), (F.col("hi") == n).alias("to")).distinct().collect()
    assert [tuple(x) for x in got] == [(True, True)] and of.leaves.filter("leaf_id <> number").count() == 0


def test_trees_that_are_none(spark):
    for rows in ([("a", "b", None), ("b", "a", None), ("v", "a", 1)], [("a", None, None), ("v", "gone", 1)]):
        with pytest.raises(ValueError):
            T.clades(tree_of(spark, rows))
    empty = T.clades(tree_of(spark, []))
    assert empty.below().count() == 0 and empty.outside().count() == 0 and empty.total == 0
    bare = T.clades(tree_of(spark, [("a", None, None), ("b", "a", None), ("v", None, 3)]))
    assert sorted((x.node_id, x.lo, x.hi) for x in bare.intervals.collect()) == [("a", 0, 0), ("b", 0, 0)] and bare.total == 0


def test_draws_are_permutations_of_other_leaves(spark):
    for size in (1, 2, 3, 10, 97, 1000):
        got = spark.range(size).select(*[T.permuted(F.col("id"), F.lit(size).cast("long"), F.lit(k)).alias(k) for k in "xy"]).collect()
        assert sorted(r.x for r in got) == sorted(r.y for r in got) == list(range(size))
        assert size < 97 or [r.x for r in got] != [r.y for r in got] and sum(r.x == i for i, r in enumerate(got)) < 12
    rows = [("r", None, None), ("x", "r", None), ("y", "r", None)] + [(f"v{i}", "x" if i < 4 else "y" if i < 9 else "r", i) for i in range(12)]
    of = T.clades(tree_of(spark, rows))
    groups = {}
    for x in T.comparison_groups(of, 40).collect():
        groups.setdefault((x.node_id, x.rep), []).append(x.leaf_id)
    assert set(groups) == {(n, k) for n in "xy" for k in range(1, 41)} and all(len(set(g)) == len(g) == (4 if n == "x" else 5) for (n, _), g in groups.items())
    assert all(not set(g) & set(range(4) if n == "x" else range(4, 9)) for (n, _), g in groups.items()) and len({frozenset(g) for g in groups.values()}) > 20
    # every other leaf is drawn about as often
    drawn = [i for (n, _), g in groups.items() if n == "x" for i in g]
    assert all(8 <= drawn.count(i) <= 34 for i in range(4, 12))
    assert T.comparison_group(of, "y", 100).count() == 7 and T.comparison_group(of, "r", 3).count() == 0
    assert "Cartesian" not in (plan := T.comparison_groups(of, 2)._jdf.queryExecution().toString()) and "NestedLoop" not in plan
    near = lambda i: 0 if i < 4 else 1 if i < 9 else 2
    edges = spark.createDataFrame([(i, j, 1 if near(i) == near(j) else 10) for i in range(12) for j in range(i + 1, 12)], "a long, b long, d long")
    got = {x.node_id: x for x in T.sampled_fixation(of, edges, 3).collect()}
    assert set(got) == {"x", "y"} and got["x"].n == 3 and 0 < got["x"].average < 1


def test_quantiles_are_exact(spark):
    r = random.Random(3)
    groups = {"a": [r.randint(-50, 10**12) for _ in range(400)], "b": [5] * 30, "c": [1, 2], None: [7, None, 9], "d": [r.choice([3, 4, 10**15]) for _ in range(101)], "e": [None]}
    rows = [(g, v, None if v is None else (r.choice([1e-200, 0.1, 1e300]) * v)) for g, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "g string, v long, x double")
    wanted = [Quantile("p5", 0.05), Quantile("p75", 0.75), Quantile("all", 1.0), Quantile("none", 0.0), median()]
    for column in (1, 2):
        name = "_vx"[column]
        got = {x.g: x for x in quantiles(df, name, wanted, ("g",), bins=(40, 1024)[column - 1]).collect()}
        by = {}
        for row in rows:
            if row[column] is not None:
                by.setdefault(row[0], []).append(row[column])
        assert set(got) == set(by)
        for g, vs in by.items():
            vs.sort()
            disc = lambda p, vs=vs: vs[max(1, math.ceil(len(vs) * p)) - 1]
            assert [got[g].p5, got[g].p75, got[g]["all"], got[g]["none"]] == [disc(0.05), disc(0.75), vs[-1], vs[0]]
            assert math.isclose(got[g].median, statistics.median(vs), rel_tol=1e-12)
    assert [tuple(x) for x in quantiles(df.filter("g = 'e'"), "v", wanted[:2]).collect()] == [(None, None)]
    assert [tuple(x) for x in quantiles(df.filter("g = 'c'"), "v", wanted[:2]).collect()] == [(1, 2)]


def test_tables_are_deleted(spark):
    IO.release(spark)
    df = IO.kept(spark.range(5).toDF("n"), "some")
    other = IO.kept(df.filter("n > 2"), "other")
    IO.discard(df)
    assert other.count() == 2 and IO.release(spark) == 1 and IO.release(spark) == 0
