"""Resampling, sharding and clustering against plain Python, and their defined results."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymart.llm import clustering, resampling, sharding

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def tuples(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


# ---------------------------------------------------------------- resampling


def word_runs(text, longest):
    words = WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    runs = [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
    return len(words), runs


def brute_resample(rows, target, longest, buckets, percent, least, seed):
    def bucket(run):
        return zlib.crc32(run.encode()) % buckets

    corpus, wanted = [0] * buckets, [0] * buckets
    features = [word_runs(t, longest) for _, t in rows]
    for _, runs in features:
        for run in runs:
            corpus[bucket(run)] += 1
    for _, text in target:
        for run in word_runs(text, longest)[1]:
            wanted[bucket(run)] += 1
    all_s, all_t = sum(corpus), sum(wanted)

    def gain(b):
        ratio = (wanted[b] + 1) * (all_s + buckets) / ((corpus[b] + 1) * (all_t + buckets))
        return math.floor(1000 * math.log(ratio))

    out = []
    for (doc, _), (words, runs) in zip(rows, features):
        weight = sum(gain(bucket(r)) for r in runs) // len(runs) if runs else 0
        score = None
        if doc is not None:
            h = int(hashlib.sha256(f"{seed}:{doc}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        out.append([doc, len(runs), weight, score, None, words])
    may = sorted((r for r in out if r[3] is not None and r[5] >= least), key=lambda r: (-r[3], r[0]))
    for place, r in enumerate(may[: len(may) * percent // 100], 1):
        r[4] = place
    return sorted(map(repr, (tuple(r[:5]) for r in out)))


@pytest.mark.parametrize("longest,buckets,percent", [(1, 10_000, 10), (3, 97, 60), (2, 1, 100)])
def test_resample_equals_brute_force(spark, docs, rows, prose, longest, buckets, percent):
    target = [(1, rows[0][1][:200]), (2, None), (3, "Shti " + prose(30))]
    options = dict(longest=longest, buckets=buckets, percent=percent, least_words=20, seed=2024)
    got = resampling.resample(docs, spark.createDataFrame(target, "item_id long, text string"), **options)
    want = brute_resample(rows, target, longest, buckets, percent, 20, 2024)
    assert sorted(map(repr, tuples(got, "doc_id", "n_features", "weight", "score", "rank"))) == want
    assert [t for _, t in got.dtypes] == ["bigint"] * 5


def test_runs_do_not_cross_texts():
    owner, numbers, words = resampling.batch_features([b"a b", b"", b"c", b"\x00D e\x00"], 2, 1 << 32)
    code = {zlib.crc32(w) for w in (b"a", b"b", b"a b", b"c", b"d", b"e", b"d e")}
    assert set(numbers.tolist()) == code and len(numbers) == 7
    assert np.bincount(owner).tolist() == [3, 0, 1, 3] and words.tolist() == [2, 0, 1, 2]


def test_slices_change_no_result(spark, docs, monkeypatch):
    target = docs.where("doc_id < 7")
    want = sorted(map(repr, resampling.resample(docs, target).collect()))
    monkeypatch.setattr(resampling, "SLICE", 50)
    assert sorted(map(repr, resampling.resample(docs.repartition(2), target).collect())) == want


def test_ranks_of_repeated_rows_are_gapless(spark):
    text = " ".join(f"w{i}" for i in range(25))
    rows = [(7, text)] * 400 + [(i, text + f" x{i}") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = resampling.resample(df, df.limit(1), percent=90).where("rank is not null")
    found = sorted(tuples(got, "rank", "score", "doc_id"))
    assert [r for r, _, _ in found] == list(range(1, 901))
    assert [(-s, d) for _, s, d in found] == sorted((-s, d) for _, s, d in found)


def test_resample_of_nothing(spark, docs, no_docs):
    assert resampling.resample(no_docs, docs).count() == 0
    got = resampling.resample(docs, no_docs, percent=100)
    assert got.count() == docs.count() and got.where("rank is not null").count() > 5
    assert resampling.resample(docs, docs, percent=0).where("rank is not null").count() == 0


# ------------------------------------------------------------------ sharding


def brute_shard(key, weights):
    costs = []
    for i, w in enumerate(weights):
        if w:
            n = int(hashlib.md5(f"{key}:{i}".encode()).hexdigest()[:13], 16)
            costs.append((-math.log((n + 0.5) / 16**13) / w, i))
    return min(costs)[1]


def sharded(spark, df, tmp_path, weights):
    folder = str(tmp_path / f"shards-{random.random()}")
    sharding.write_shards(df, folder, weights)
    return sharding.read_shards(spark, folder, df.select(F.struct("*")).schema[0].dataType)


@pytest.mark.parametrize("weights", [[1.0] * 5, [3.0, 0.0, 1.0, 0.5]])
def test_shards_equal_brute_force_and_keep_every_row(spark, docs, rows, tmp_path, weights):
    got = sharded(spark, docs, tmp_path, weights).select("shard", "slot", "record.*")
    assert set(docs.columns) < set(got.columns)
    found = tuples(got, "doc_id", "text", "shard", "slot")
    assert sorted(map(repr, ((d, t) for d, t, _, _ in found))) == sorted(map(repr, rows))
    for doc, text, shard, _ in found:
        key = doc if doc is not None else "text:" + hashlib.md5((text or "").encode()).hexdigest()
        assert shard == brute_shard(key, weights)
    for shard in {s for _, _, s, _ in found}:
        own = sorted((slot, d is not None, d or 0) for d, _, s, slot in found if s == shard)
        assert [slot for slot, _, _ in own] == list(range(len(own)))
        assert own == sorted(own, key=lambda r: r[1:])


def test_growth_and_weights_move_rows_into_one_shard_only(spark):
    keys = spark.range(20_000).select(F.col("id").cast("string").alias("key"))

    def shards(weights):
        return F.col("key"), sharding.rendezvous(F.col("key"), weights)

    def moved(before, after):
        a, b = sharding.rendezvous(F.col("key"), before), sharding.rendezvous(F.col("key"), after)
        found = keys.select(a.alias("a"), b.alias("b")).where("a <> b").groupBy("b").count().collect()
        return {r["b"]: r["count"] for r in found}

    grown = moved([1.0] * 24, [1.0] * 25)
    assert set(grown) == {24} and abs(grown[24] - 800) < 150
    heavier = moved([1.0] * 4, [1.0, 2.0, 1.0, 1.0])
    assert set(heavier) == {1} and abs(heavier[1] - 3000) < 300  # from a quarter to two fifths
    sizes = keys.groupBy(sharding.rendezvous(F.col("key"), [3.0, 1.0]).alias("s")).count().collect()
    assert abs({r["s"]: r["count"] for r in sizes}[0] - 15_000) < 300


def test_a_repeated_key_is_spread_over_tasks_and_slots_stay_gapless(spark, tmp_path):
    df = spark.createDataFrame([(7, "t")] * 3000 + [(i, "u") for i in range(300)], "doc_id long, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        folder = str(tmp_path / "hot")
        sharding.write_shards(df.repartition(4), folder, [1.0, 1.0])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = spark.read.parquet(folder).where("record.doc_id = 7 and record.text = 't'")
    assert files.select(F.input_file_name()).distinct().count() > 3
    got = sharding.read_shards(spark, folder, df.select(F.struct("*")).schema[0].dataType)
    for r in got.groupBy("shard").agg(F.count("*"), F.min("slot"), F.max("slot"), F.count_distinct("slot")).collect():
        assert (r[2], r[3], r[4]) == (0, r[1] - 1, r[1])


def test_digest_of_shards(spark, docs, no_docs, rows, tmp_path):
    got = sharding.shard_digest(docs, str(tmp_path / "digest"), 3)
    found = sorted(map(repr, tuples(got, "doc_id", "size", "text_crc32")))
    texts = [(d, (t or "").encode()) for d, t in rows]
    assert found == sorted(repr((d, len(b) + 8, zlib.crc32(b))) for d, b in texts)
    assert got.where("grown_shard <> shard and grown_shard <> 3").count() == 0
    assert sharding.shard_digest(no_docs, str(tmp_path / "none"), 3).count() == 0


@pytest.mark.parametrize("weights", [[], [0.0], [1.0, -1.0], [float("nan")]])
def test_bad_weights(spark, weights):
    with pytest.raises(ValueError):
        sharding.rendezvous(F.lit("a"), weights)


# ---------------------------------------------------------------- clustering


def brute_cluster(rows, k, rounds, dims, scale, seed):
    kept = []
    for i, e in rows:
        if e is not None and len(e) == dims and all(x is not None and math.isfinite(x) for x in e):
            kept.append((i, [math.floor(scale * x) for x in e]))

    def order(row):
        number = "" if row[0] is None else row[0]
        return hashlib.sha256(f"{seed}:{number}".encode()).hexdigest(), row[1]

    centroids = [v for _, v in sorted(kept, key=order)[:k]]

    def assigned():
        return [
            min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids)) for _, v in kept
        ]

    for _ in range(rounds):
        where = [j for _, j in assigned()]
        for j in set(where):
            own = [v for (_, v), c in zip(kept, where) if c == j]
            centroids[j] = [sum(x) // len(own) for x in zip(*own)]
    last = assigned()
    inertia = {j: sum(d for d, c in last if c == j) for j in range(len(centroids))}
    return sorted(
        repr((i, j, d, inertia[j], sum(inertia.values()), clustering.centroid_digest(centroids[j])))
        for (i, _), (d, j) in zip(kept, last)
    )


def vectors(seed, n, dims, blobs, spread):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(blobs, dims)) * 3
    found = (centres[rng.integers(0, blobs, n)] + rng.normal(size=(n, dims)) * spread).astype(np.float32)
    return [(i, [float(x) for x in v]) for i, v in enumerate(found)]


SCHEMA = "vec_id long, embedding array<float>, label int, cluster int, v string, distance double"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "v", 0.5) for r in rows], SCHEMA)


@pytest.mark.parametrize("seed,k,dims,pivots", [(0, 16, 64, 8), (1, 5, 3, 5), (2, 9, 1, 4), (3, 7, 8, 1)])
def test_clusters_equal_brute_force(spark, seed, k, dims, pivots):
    rows = vectors(seed, 300, dims, 6, 0.4)
    odd = [None, [], [None] * dims, [float("nan")] * dims, [float("inf")] * dims, [0.0] * (dims + 1)]
    rows += [(1000 + i, e) for i, e in enumerate(odd)] + [(None, rows[0][1]), (None, rows[1][1])]
    rows += [(3, rows[3][1]), (2000, rows[4][1])] + [(3000 + i, [0.25] * dims) for i in range(150)]
    options = dict(k=k, rounds=3, dims=dims, scale=64.0, seed=1)
    got = clustering.cluster_digest(frame(spark, rows).repartition(7), pivots=pivots, **options)
    columns = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    assert sorted(map(repr, tuples(got, *columns))) == brute_cluster(rows, **options)


def test_fewer_vectors_than_centroids_and_equal_ones(spark):
    rows = [(i, [1.0, 2.0]) for i in range(3)]
    got = clustering.cluster_digest(frame(spark, rows), k=5, dims=2)
    assert {r["cluster"] for r in got.collect()} == {0} and got.count() == 3
    assert clustering.cluster_digest(frame(spark, []), k=5, dims=2).count() == 0


def test_components_that_outgrow_a_long_are_refused(spark):
    with pytest.raises(Exception, match="beyond"):
        clustering.cluster_digest(frame(spark, [(1, [3e30, 0.0])]), k=2, dims=2)


def test_bounds_hold_and_filter():
    rng = np.random.default_rng(4)
    v = rng.integers(-400, 400, (2000, 16))
    centroids = np.vstack([v[:12], rng.integers(-50, 50, (6, 16))])
    simplex = clustering.Simplex(centroids[:10])
    maybe = clustering.candidates(
        simplex.apexes(simplex.distances(v)), simplex.apexes(simplex.distances(centroids))
    )
    exact = np.stack([clustering.squared_distances(v, c) for c in centroids], 1)
    assert maybe[np.arange(2000), exact.argmin(1)].all()
    assert maybe.mean() < 0.9
    # the apexes reproduce the distances to the pivots themselves
    assert (simplex.distances(v) == exact[:, :10]).all()


def test_dependent_pivots_are_left_out():
    line = np.array([[0, 0], [2, 0], [4, 0], [4, 0], [0, 3]])
    assert len(clustering.Simplex(line).pivots) == 3
