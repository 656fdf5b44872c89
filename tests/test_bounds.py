"""What a task holds at a time does not grow with a batch."""

from locusframe import sketch as K


def test_motif_spans_leave_a_task_in_pieces(spark, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(K, "SCAN", 100)
    monkeypatch.setattr(K, "SPANS", 30)
    texts = ["ab" * 40, None, "", "xabx" * 100, "ab"]
    made = []

    class Rows:
        """The task itself, on one batch."""

        schema = spark.createDataFrame([], "sample long, seq string").schema

        def select(self, *_):
            return self

        def mapInArrow(self, task, schema):
            made.extend(task(iter([pa.RecordBatch.from_arrays([pa.array(range(5)), pa.array(texts)], ["sample", "seq"])])))

    K.motif_spans(Rows(), [("m", "ab", 1.0)])
    assert max(b.num_rows for b in made) <= 30 and sum(b.num_rows for b in made) == 141
    rows = [(x["sample"], x["start"]) for b in made for x in b.to_pylist()]
    assert rows == [(0, 2 * i + 1) for i in range(40)] + [(3, 4 * i + 2) for i in range(100)] + [(4, 1)]
    frame = spark.createDataFrame(list(enumerate(texts)), "sample long, seq string")
    assert sorted((x.sample, x.start) for x in K.motif_spans(frame, [("m", "ab", 1.0)]).collect()) == rows


def test_opened_stretches_and_draws_are_dealt_to_several_tasks(spark, monkeypatch):
    from dataclasses import replace

    from pyspark.sql import functions as F

    from locusframe import clades as T

    monkeypatch.setattr(T, "GROUP", 16)
    tree = [("root", None, None), ("p", "root", None), ("q", "root", None)] + [(f"v{i}", "pq"[i % 2], i) for i in range(300)]
    of = T.clades(spark.createDataFrame(tree, "node_id string, parent_id string, leaf_id long"))
    of = replace(of, leaves=F.broadcast(of.leaves))
    tasks = lambda df: df.select(F.spark_partition_id().alias("t")).distinct().count()
    # the stretches are a few small rows, which Spark would put into one partition
    assert tasks(of.below()) > 1 and tasks(T.comparison_groups(of, 2)) > 1
    assert of.below().count() == 600 and T.comparison_groups(of, 2).count() == 600


def test_jaccard_leaves_no_pairs_to_a_shuffle(spark, monkeypatch):
    import random

    r = random.Random(6)
    sets = {f"s{i}": {r.randrange(60) ** 2 for _ in range(r.randint(1, 12))} for i in range(150)}
    rows = [(k, x) for k, v in sets.items() for x in v] + [("s1", None), (None, 1), ("alone", -1)]
    frame = spark.createDataFrame(rows + rows[:40], "sample string, kmer long")
    want = {(a, b): (len(sets[a] & sets[b]), len(sets[a] | sets[b])) for a in sets for b in sets if a < b and sets[a] & sets[b]}
    for blocks, pairs in ((1, 1 << 20), (4, 100), (None, 7)):
        monkeypatch.setattr(K, "PAIRS", pairs)
        got = K.jaccard(frame, blocks=blocks)
        assert sorted((x.a, x.b, x.common, x.total) for x in got.collect()) == sorted((*k, *v) for k, v in want.items())
    # counted in the last step, from blocks: nothing is moved after it
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.split("MapInArrow")[0].split("Initial Plan")[0] and K.jaccard(frame.limit(0)).count() == 0


def test_site_filter_reads_its_genotypes_once(spark):
    from pyspark.sql import functions as F

    from locusframe import sites as S

    seen = spark.sparkContext.accumulator(0)

    def task(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = [("c", p, "A", s, "ACGT"[(p + s) % 4]) for p in range(1, 400, 7) for s in range(3)]
    frame = spark.createDataFrame(rows, "contig string, pos long, ref string, sample long, nt string")
    mask = spark.createDataFrame([("c", 100, 150)], "contig string, lo long, hi long")
    got = S.site_filter(frame.mapInArrow(task, frame.schema), mask=mask, flanking=50)
    assert sorted(x.pos for x in got.select("pos").distinct().collect()) == [50, 155, 211, 267, 323, 379]
    assert got.agg(F.count(F.lit(1))).first()[0] == 18 and seen.value == len(rows)


def test_chunks_of_texts_take_little_memory():
    import tracemalloc

    import pyarrow as pa

    from locusframe.llm import arrays as A
    from locusframe.llm import nearcopies, quality
    from locusframe.llm.repeats import Tokens

    column = pa.array([" ".join(f"w{(i * j) % 977}" for j in range(400)) for i in range(3000)] + [None, ""])
    tracemalloc.start()
    try:
        for work in (quality.measure, nearcopies.shingle_sets, lambda *x: (t := Tokens("words", 35, 10)).runs(*t.hashes(*x))):
            rows = 0
            for at, end, data, offsets in A.chunks(column):
                work(data, offsets)
                rows += end - at
            assert rows == 3002
        assert tracemalloc.get_traced_memory()[1] < 64 << 20
    finally:
        tracemalloc.stop()


def test_a_batch_gives_its_memory_back():
    import subprocess
    import sys

    # many small pieces, then one that stands behind them: the allocator alone keeps them all
    code = """
import pyarrow as pa
from locusframe.llm import arrays as A
held = lambda: int(open("/proc/self/statm").read().split()[1]) * 4096 >> 20
before = held()
for _ in A.chunks(pa.array(["a b"])):
    pieces = [bytes(100_000) for _ in range(2000)]
    last = bytes(100_000)
    del pieces
print(held() - before)
"""
    assert int(subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout) < 60
