"""Clusters and ranks on the distance graph."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locusframe import pairs
from locusframe.clades import clades
from locusframe.sources import kept


def components(edges: DataFrame) -> DataFrame:
    """node, cluster (its smallest node) of the graph with edges (a, b). Star steps: each node hands its larger neighbours,
    then its smaller ones, to its smallest; every round is written."""
    links = kept(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), "links")
    seen = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = kept(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "low")
        links = both.filter("b > a").join(low, "a").select(F.col("m").alias("a"), "b").filter("a < b").distinct()
        low = links.groupBy("b").agg(F.min("a").alias("m"))
        links = links.join(low, "b").select(F.col("m").alias("x"), F.explode(F.array("a", "b")).alias("y")).filter("x < y")
        links = kept(links.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "links")
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    roots = links.select(F.col("a").alias("node"), F.col("a").alias("cluster")).distinct()
    return links.select(F.col("b").alias("node"), F.col("a").alias("cluster")).unionByName(roots)


def clusters(edges: DataFrame, most: int, least_size: int = 2) -> DataFrame:
    """node, cluster, size: single linkage of edges (a, b, d) with d <= most."""
    found = kept(components(edges.filter(F.col("d") <= most)), "components")
    sizes = found.groupBy("cluster").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") >= least_size)
    return found.join(sizes, "cluster").select("node", "cluster", "size")


def spanning_forest(edges: DataFrame) -> DataFrame:
    """a, b, d (a < b): the minimum spanning forest of edges (a, b, d), of equal distances the smaller (a, b).

    Each round every component takes its shortest edge outwards, and what that joins becomes one component, so rounds grow with
    the logarithm of the number of nodes. Shortest edges are aggregated before the shuffle; parallel edges go.
    """
    plain = edges.filter("a <> b and d is not null").groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.min("d").alias("d"))
    cur, found = kept(plain.select("a", "b", "d", F.col("a").alias("u"), F.col("b").alias("v")), "open-edges"), None
    while found is None or cur.limit(1).count():
        end = lambda x, y: cur.select(F.col(x).alias("u"), F.struct("d", "a", "b", F.col(y).alias("to")).alias("e"))
        best = kept(end("u", "v").unionByName(end("v", "u")).groupBy("u").agg(F.min("e").alias("e")), "shortest")
        chosen = best.select("e.a", "e.b", "e.d").distinct()
        found = chosen if found is None else found.unionByName(chosen)
        # the edges are in a strict order, so the only cycles are two that choose each other; the smaller is their root
        other = best.select(F.col("u").alias("o"), F.col("e.to").alias("back"))
        up = kept(best.join(other, F.col("e.to") == F.col("o")).select("u", F.when((F.col("back") == F.col("u")) & (F.col("u") < F.col("o")), F.col("u")).otherwise(F.col("o")).alias("p")), "hooks")
        while True:
            onto = up.select(F.col("u").alias("o"), F.col("p").alias("q"))
            further = kept(up.join(onto, F.col("p") == F.col("o")).select("u", F.col("q").alias("p"), (F.col("p") != F.col("q")).alias("moved")), "hooks")
            up = further.select("u", "p")
            if further.filter("moved").limit(1).count() == 0:
                break
        left, right = up.withColumnsRenamed({"u": "x", "p": "ru"}), up.withColumnsRenamed({"u": "y", "p": "rv"})
        rest = cur.join(left, F.col("u") == F.col("x")).join(right, F.col("v") == F.col("y")).filter("ru <> rv")
        rest = rest.groupBy(F.least("ru", "rv").alias("u"), F.greatest("ru", "rv").alias("v")).agg(F.min(F.struct("d", "a", "b")).alias("e"))
        cur = kept(rest.select("e.a", "e.b", "e.d", "u", "v"), "open-edges")
    return kept(found.distinct(), "forest")


def dendrogram(forest: DataFrame, levels: int) -> DataFrame:
    """node, level, into: single linkage of a forest's edges (a, b, level from 0 to below levels), to be cut anywhere.

    A cluster is known by its smallest node; at `level` node's cluster joins that of `into`, which has a smaller one. The
    clusters at level t are what the rows with level <= t connect. Levels are halved: the lower half is solved on the nodes,
    the upper half on the clusters of the lower, both at once, so it takes log(levels) rounds of components.
    """
    width = 1 << max(levels - 1, 0).bit_length()
    cur = forest.select(F.lit(0).alias("lo"), F.col("a").alias("u"), F.col("b").alias("v"), "level")
    named = lambda df: df.select(F.struct("lo", F.col("u").alias("x")).alias("a"), F.struct("lo", F.col("v").alias("x")).alias("b"))
    while width > 1:
        width //= 2
        high = F.col("level") >= F.col("lo") + width
        label = kept(components(named(cur.filter(~high))).select("node.lo", "node.x", F.col("cluster.x").alias("to")), "halves")
        upper = cur.filter(high)
        for end in ("u", "v"):
            of = label.withColumnsRenamed({"lo": "l", "x": "y"})
            upper = upper.join(of, (F.col("lo") == F.col("l")) & (F.col(end) == F.col("y")), "left").withColumn(end, F.coalesce("to", end)).drop("l", "y", "to")
        cur = kept(cur.filter(~high).unionByName(upper.withColumn("lo", F.col("lo") + width)), "levels")
    last = components(named(cur))
    return kept(last.filter("node <> cluster").select(F.col("node.x").alias("node"), F.col("node.lo").alias("level"), F.col("cluster.x").alias("into")), "dendrogram")


def limited_clusters(edges: DataFrame, most: int, largest: int, step: int = 100, floor: int = 5) -> DataFrame:
    """node, cluster, size, at: where a cluster has more than `largest` nodes, its distance limit goes down by `step` (to
    `floor` at least) until its parts are small enough; parts at the floor stay as they are. Single nodes are no cluster.

    One spanning forest and one dendrogram serve all limits. A merge holds if the cluster that it makes is small enough or
    it is one at the floor; its size is the sum of what has joined up to its level, by the sizes of the dendrogram's subtrees.
    """
    limits = [most]
    while limits[-1] > floor:
        limits.append(max(floor, limits[-1] - step))
    n = len(limits)
    down = F.when(F.col("d") <= limits[-1], n - 1).otherwise(F.floor((F.lit(most) - F.col("d")) / step))
    forest = spanning_forest(edges.filter(F.col("d") <= most)).withColumn("level", (n - 1 - down).cast("int"))
    joins = dendrogram(forest, n)
    nodes = joins.select("node", F.col("into").alias("up")).unionByName(joins.select(F.col("into").alias("node"), F.lit(None).cast(joins.schema["into"].dataType).alias("up")))
    nodes = nodes.groupBy("node").agg(F.max("up").alias("up"))
    # the dendrogram as a tree with one leaf a node; a subtree's leaves are an interval
    tree = nodes.select(F.col("node").alias("node_id"), F.col("up").alias("parent_id"), F.lit(None).cast("boolean").alias("leaf_id"))
    tree = tree.unionByName(nodes.select("node", F.col("node"), F.lit(True)).toDF("node_id", "parent_id", "leaf_id"))
    whole = clades(tree).intervals.select(F.col("node_id").alias("of"), (F.col("hi") - F.col("lo")).alias("whole"))
    made = joins.join(whole, F.col("node") == F.col("of")).groupBy("into", "level").agg(F.sum("whole").alias("more"))
    # as many rows a cluster as levels at most
    made = made.withColumn("size", 1 + F.sum("more").over(Window.partitionBy("into").orderBy("level"))).select(F.col("into").alias("i"), F.col("level").alias("l"), "size")
    judged = joins.join(made, (F.col("into") == F.col("i")) & (F.col("level") == F.col("l"))).select("node", "into", "level", ((F.col("size") <= largest) | (F.col("level") == 0)).alias("holds"))
    judged = kept(judged, "merges")
    found = components(judged.filter("holds").select(F.col("node").alias("a"), F.col("into").alias("b")))
    found = kept(found, "components")
    sizes = found.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    # the first merge with the cluster that does not hold ends it
    ends = judged.filter("not holds").select(F.explode(F.array("node", "into")).alias("r"), "level").groupBy("r").agg(F.min("level").alias("ended"))
    ends = sizes.join(ends, F.col("cluster") == F.col("r"), "left")
    at = F.element_at(F.array(*[F.lit(x) for x in reversed(limits)]), F.coalesce("ended", F.lit(n)).cast("int"))
    return found.join(ends.select("cluster", "size", at.alias("at")), "cluster").select("node", "cluster", "size", "at")


def cluster_statistics(members: DataFrame, edges: DataFrame, most: int) -> DataFrame:
    """cluster, size, mean, spread, least, largest of the distances between a cluster's members; missing pairs count `most`.

    mean and spread are cut to whole numbers. Only pairs with an edge are joined; the others enter by their number.
    """
    a = members.select(F.col("node").alias("a"), F.col("cluster"))
    b = members.select(F.col("node").alias("b"), F.col("cluster").alias("c2"))
    inside = edges.join(a, "a").join(b, "b").filter("cluster = c2")
    m = inside.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.sum("d").alias("s"), F.sum(F.col("d") * F.col("d")).alias("q"), F.min("d").alias("lo"), F.max("d").alias("hi"))
    return _statistics(members, m, most)


def cluster_statistics_packed(members: DataFrame, alignment: DataFrame, most: int) -> DataFrame:
    """cluster_statistics of the clusters' sequences, from counts of their distances: no row a pair."""
    own = alignment.join(members.select(F.col("node").alias("sample"), "cluster"), "sample")
    counted = pairs.within_groups(own, "cluster")
    d = F.col("d")
    m = counted.groupBy(F.col("x").alias("cluster")).agg(F.sum("n").alias("n"), F.sum(d * F.col("n")).alias("s"), F.sum(d * d * F.col("n")).alias("q"), F.min("d").alias("lo"), F.max("d").alias("hi"))
    return _statistics(members, m, most)


def _statistics(members: DataFrame, m: DataFrame, most: int) -> DataFrame:
    sizes = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    rows = sizes.join(m, "cluster", "left").na.fill(0, ["n", "s", "q"]).withColumn("pairs", F.floor(F.col("size") * (F.col("size") - 1) / 2).cast("long"))
    rows = rows.withColumn("none", F.col("pairs") - F.col("n")).withColumn("s", F.col("s") + F.col("none") * most).withColumn("q", F.col("q") + F.col("none") * most * most)
    mean = F.col("s") / F.col("pairs").cast("double")
    # products of two sums outgrow a long in a cluster of some ten thousand nodes
    n, s, q = (F.col(c).cast("decimal(19,0)") for c in ("pairs", "s", "q"))
    variance = (q * n - s * s).cast("double") / F.nullif((n * (n - 1)).cast("double"), F.lit(0.0))
    some = F.col("none") > 0
    return rows.select("cluster", "size", mean.cast("long").alias("mean"), F.sqrt(variance).cast("long").alias("spread"), F.when(some, F.least("lo", F.lit(most))).otherwise(F.col("lo")).cast("long").alias("least"), F.when(some, F.greatest("hi", F.lit(most))).otherwise(F.col("hi")).cast("long").alias("largest"))


def weights(edges: DataFrame) -> DataFrame:
    """a, b, w: distances as weights in (0, 1], nearer is heavier."""
    top = edges.agg((F.max("d") + 1).alias("m"))
    w = F.greatest((F.col("m") - (F.col("d") + 1)) / F.col("m").cast("double"), 1 / F.col("m").cast("double"))
    return edges.crossJoin(F.broadcast(top)).select("a", "b", w.alias("w"))


def repeated_edges(edges: DataFrame) -> DataFrame:
    """a, b, n: pairs that occur more than once, in either direction."""
    return edges.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


#: A node with more arcs than this, and than a 1,024th of all, has them dealt out over parts.
HUB = 100_000


def _sent(arcs: DataFrame, ranks: DataFrame, hubs: DataFrame) -> DataFrame:
    """to, in: what each node gets. ranks (node, rank) go to where the arcs of a node, or of a part of a hub, are."""
    dealt = ranks.join(F.broadcast(hubs), F.col("node") == F.col("hub"), "left").select("node", "rank", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("of"))
    return arcs.join(dealt, (F.col("a") == F.col("node")) & (F.col("part") == F.col("of"))).groupBy(F.col("b").alias("to")).agg(F.sum(F.col("p") * F.col("rank")).alias("in"))


def pagerank(weighted: DataFrame, damping: float = 0.85, rounds: int = 20, every: int = 5) -> DataFrame:
    """node, rank of the undirected graph (a, b, w): so many rounds of power iteration; ranks add up to 1.

    Arcs are dealt out by the node that they leave once, and stay where they are: a round moves ranks and partial sums. Every
    node has an arc to it, so what is sent names them all. Lost parts of the arcs are made again from the written table.
    """
    arcs = weighted.unionByName(weighted.select(F.col("b").alias("a"), F.col("a").alias("b"), "w"))
    per = kept(arcs.groupBy("a").agg(F.sum("w").alias("t"), F.count(F.lit(1)).alias("arcs")).withColumnRenamed("a", "of"), "arc-weights")
    count, n = per.agg(F.coalesce(F.sum("arcs"), F.lit(0)), F.count(F.lit(1))).first()
    parts = F.ceil(F.col("arcs") / max(HUB, count / 1024)).cast("int")
    # 1,024 rows at most
    hubs = kept(per.filter(parts > 1).select(F.col("of").alias("hub"), parts.alias("parts")), "hubs")
    part = F.pmod(F.xxhash64("b"), parts).cast("int")
    arcs = kept(arcs.join(per, F.col("a") == F.col("of")).select("a", "b", (F.col("w") / F.col("t")).alias("p"), part.alias("part")), "arcs")
    ranks = per.select(F.col("of").alias("node"), F.lit(1.0 / max(n, 1)).alias("rank"))
    held = arcs.repartition(int(arcs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "a", "part").persist(StorageLevel.MEMORY_AND_DISK)
    for k in range(1, rounds + 1):
        ranks = _sent(held, ranks, hubs).select(F.col("to").alias("node"), (F.lit((1 - damping) / max(n, 1)) + damping * F.col("in")).alias("rank"))
        if k % every == 0 or k == rounds:
            ranks = kept(ranks, "ranks")
    held.unpersist()
    return ranks


def index_case(ranks: DataFrame) -> DataFrame:
    """The node of the highest rank; ties (to nine places) to the smaller one."""
    return ranks.select("node", F.round("rank", 9).alias("rank")).orderBy(F.desc("rank"), "node").limit(1)
