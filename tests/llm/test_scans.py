import random
from collections import Counter

import brute
import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from tallymart.llm import catalog, decontaminate, license_scan, packing, quality, secret_scan, warc_bundles


def test_secrets(docs, rows, no_docs):
    got = Counter(tuple(r) for r in secret_scan.scan_secrets(docs).collect())
    expected = Counter((d, *brute.secrets(t, secret_scan.CLASSES, secret_scan.ALLOW_LIST)) for d, t in rows)
    assert got == expected
    assert secret_scan.scan_secrets(no_docs).collect() == []


def test_secrets_in_a_text_with_many_matches(spark):
    text = " é ".join(f"{k:016x}" for k in range(1000))
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert tuple(secret_scan.scan_secrets(frame).first())[1:] == brute.secrets(
        text, secret_scan.CLASSES, secret_scan.ALLOW_LIST
    )


LONG = {
    "words": "ab/" * 100_000 + "z",
    "lower": "a" * 300_000,
    "upper": "A" * 300_000,
    "digits": "7" * 300_000,
    "marks": "+/" * 150_000,
    "uuids": "0123abcd-01ab-01ab-01ab-0123456789ab" * 8_000,
    "example": "k3" * 100_000 + "example" + "Z9" * 100_000,
    "access": "AKIA" + "Z7" * 150_000,
    "assign": "password = " + "x1-" * 100_000,
    "hex": "0a" * 150_000,
    "spaces": "token" + " " * 300_000 + "= " + "q" * 20,
}


@pytest.mark.parametrize("name", sorted(LONG))
def test_secrets_survive_very_long_matches(spark, name):
    """Every kind and allow-list pattern over a hundred thousand repetitions."""
    text = LONG[name]
    got = spark.createDataFrame([(1, text)], "doc_id long, text string").select(
        *[F.col("text").rlike(f"^(?:{p})$").alias(f"a{i}") for i, p in enumerate(secret_scan.ALLOW_LIST)],
        *[
            F.size(F.regexp_extract_all("text", F.lit(p), F.lit(0))).alias(f"k{i}")
            for i, p in enumerate((secret_scan.ASSIGN, secret_scan.ACCESS, secret_scan.HEX, *[c.candidate for c in secret_scan.CLASSES]))
        ],
    ).first()
    assert any(got)


def test_secrets_in_a_long_path(spark):
    text = "see " + "ab/" * 20_000 + "z end"
    got = secret_scan.scan_secrets(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert tuple(got)[1:] == brute.secrets(text, secret_scan.CLASSES, secret_scan.ALLOW_LIST)


def test_secrets_run_no_python(spark, small):
    plan = catalog.op2_secrets(spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_licenses(spark):
    files = [
        ("a/LICENSE", "This work is licensed under the GNU General Public License, version 3."),
        ("a/x.py", "code"), ("a/b/y.py", None), ("a/b/c/z.py", "Released under the MIT License.\nbody"),
        ("a/b/c/COPYING", "Licensed under CC BY-NC 4.0."), ("a/b/c/d/w.py", ""),
        ("top.py", "no notice here"), ("c/v.py", "we talk of copyright and other things at length here"), (None, "Released under the MIT License."),
        ("a/x.py", "code"),
    ]
    frame = spark.createDataFrame([(*f, 1, 2) for f in files], "path string, text string, term int, line int")
    got = Counter((r.path, r.license, r.how, r.inherited_from) for r in license_scan.scan_licenses(frame).collect())
    assert got == Counter(
        {
            ("a/LICENSE", "GPL-3.0", "own", None): 1, ("a/x.py", "GPL-3.0", "inherited", "a"): 2,
            ("a/b/y.py", "GPL-3.0", "inherited", "a"): 1, ("a/b/c/z.py", "MIT", "own", None): 1,
            ("a/b/c/COPYING", "CC-BY-NC-4.0", "own", None): 1,
            ("a/b/c/d/w.py", "CC-BY-NC-4.0", "inherited", "a/b/c"): 1,
            ("top.py", None, "none", None): 1, ("c/v.py", None, "none", None): 1, (None, None, "none", None): 1,
        }
    )
    assert license_scan.scan_licenses(frame.limit(0)).collect() == []


def test_license_similarity_is_the_tf_idf_cosine(spark):
    import math
    import re

    texts = ["Released under the MIT License.", "licensed under the terms of the MIT license", "all rights, copyright mine"]
    frame = spark.createDataFrame([(f"f{k}", t) for k, t in enumerate(texts)], "path string, text string")
    bags = [Counter(re.findall(license_scan.TERM, t.lower())) for t in texts]
    df = Counter(t for b in bags for t in b)

    def vector(bag):
        v = {t: n * (math.log((1 + len(texts)) / (1 + df[t])) + 1) for t, n in bag.items()}
        size = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / size for t, x in v.items()}

    notices = [vector(Counter(re.findall(license_scan.TERM, n.lower()))) for _, n in license_scan.TEMPLATES]
    best = {
        f"f{k}": round(max(sum(x * n.get(t, 0) for t, x in vector(b).items()) for n in notices), 6)
        for k, b in enumerate(bags)
    }
    got = {r.path: r.similarity for r in license_scan.own_licenses(frame).collect()}
    assert got == pytest.approx({p: s for p, s in best.items() if s >= license_scan.LEAST_COSINE}, abs=2e-6)


def test_near_licenses_are_told_apart(spark):
    """Whole texts, headers over several lines in comments, and very many empty lines."""
    from textwrap import fill

    scan, last = license_scan, {}
    for name, text in scan.TEMPLATES:
        if len(text) > len(last.get(name, "")):
            last[name] = text
    names = ["MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "GPL-2.0", "Apache-2.0"]
    files = [(f"{n}/LICENSE", "Copyright (c) 2021 Some One\n\n" + fill(last[n], 70)) for n in names]
    header = "#!/bin/sh\n#\n{}\n#\nimport os\n\ndef f():\n    return 1\n"
    files += [(f"src/{n}.py", header.format("\n".join("# " + t for t in fill(last[n], 60).split("\n")))) for n in names]
    files += [("far.py", fill(last["AGPL-3.0"], 60) + "\n" * 100_000 + "print()"), ("none.py", "no\nlicense\nis meant here")]
    frame = spark.createDataFrame(files, "path string, text string")
    got = {r.path: r.license for r in scan.own_licenses(frame).collect()}
    assert got == {f"{n}/LICENSE": n for n in names} | {f"src/{n}.py": n for n in names} | {"far.py": "AGPL-3.0"}


def test_texts_under_one_path_are_not_mixed(spark):
    notices = dict(reversed(license_scan.TEMPLATES))
    files = [("a/LICENSE", notices["MIT"]), ("a/LICENSE", notices["GPL-2.0"]), ("a/LICENSE", notices["GPL-2.0"])]
    files += [("a/x.py", "print(1)"), ("b/LICENSE", notices["MIT"]), ("b/LICENSE", "all rights reserved, no license")]
    frame = spark.createDataFrame(files, "path string, text string")
    own = {r.path: (r.license, r.similarity) for r in license_scan.own_licenses(frame).collect()}
    assert own == {"a/LICENSE": ("GPL-2.0", 1.0), "b/LICENSE": ("MIT", 1.0)}  # a tie goes by the alphabet
    got = Counter((r.path, r.license, r.how) for r in license_scan.scan_licenses(frame).collect())
    assert got["a/LICENSE", "GPL-2.0", "own"] == 3 and got["a/x.py", "GPL-2.0", "inherited"] == 1


def test_decontaminate(spark, docs, no_docs, prose):
    rng = random.Random(9)
    items = [(k, prose(rng.randint(20, 40))) for k in range(6)] + [(6, None), (7, ""), (None, prose(30)), (8, "too short")]
    bench = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, hit_id string")
    edited = items[1][1][:40] + "zz" + items[1][1][41:]
    texts = [
        (1, prose(30) + " " + items[0][1].upper() + ". " + prose(30)), (2, edited), (3, prose(200)), (4, None), (5, ""),
        (6, items[2][1].replace(" ", "\n ")), (7, items[3][1][:60] + prose(10)),
    ]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: (r.contaminated, r.regions) for r in decontaminate.decontaminate(frame, bench).collect()}
    assert {d for d, (hit, _) in got.items() if hit} == {1, 2, 6} and len(got) == len(texts)
    item, begin, end, n = map(int, got[1][1].split(":"))
    assert (item, n) == (0, 0) and texts[0][1][begin:end] == items[0][1].upper()
    assert {r.doc_id for r in decontaminate.without_contaminated(frame, bench).collect()} == {3, 4, 5, 7}
    assert decontaminate.decontaminate(no_docs, bench).collect() == []
    assert not any(r.contaminated for r in decontaminate.decontaminate(frame, bench.limit(0)).collect())


def test_decontaminate_finds_passages_from_any_place(spark, prose):
    rng = random.Random(31)
    size = decontaminate.WINDOW
    items = [(k, prose(60)) for k in range(8)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    texts = []
    for k, item in items:
        item = decontaminate.reduced(item)
        for begin in range(0, 40):
            texts.append((len(texts), f"{prose(20)} {item[begin : begin + size].strip()} {prose(20)}"))
    frame = spark.createDataFrame(texts + [(len(texts), prose(400))], "doc_id long, text string")
    got = {r.doc_id for r in decontaminate.decontaminate(frame, bench).where("contaminated").collect()}
    assert got == set(range(len(texts)))


def test_decontaminate_query_against_brute_force(spark, prose, tmp_path):
    rng = random.Random(77)
    items = [(1, prose(14)), (2, prose(16)), (3, prose(9)[:60])]
    parts = [decontaminate.reduced(t) for _, t in items]
    texts = []
    for part in parts:
        for changes in (0, 3, 5, 6, 9):
            begin = rng.randrange(max(1, len(part) - decontaminate.WINDOW))
            cut = list(part[begin : begin + decontaminate.WINDOW])
            for at in rng.sample(range(len(cut)), changes):
                cut[at] = "Z" if rng.random() < 0.5 else cut[at] + "q"
            texts.append((len(texts) // 2, prose(4) + " " + "".join(cut) + " " + prose(4)))
    texts += [(None, texts[0][1]), (None, prose(12)), (90, ""), (91, None)]
    frame = spark.createDataFrame([(*t, "x", 1) for t in texts], "doc_id long, text string, digest string, found int")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    want = Counter()
    for doc, text in texts:
        text = decontaminate.reduced(text or "")
        hit = False
        for part in parts:
            rule = decontaminate.Rule.of(len(part))
            for begin in range(len(part) - rule.size + 1):
                hit = hit or brute.edits(part[begin : begin + rule.size], text) <= rule.edits
        want[doc, hit] += 1
    got = catalog.QUERIES["op4_decontaminate"](spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.contaminated) for r in got) == want
    assert {hit for _, hit in want} == {True, False}
    assert all((r.n_regions > 0) == r.contaminated == bool(r.regions) for r in got)


def test_decontaminate_in_blocks_and_long_texts(spark, prose, monkeypatch):
    items = [(k, prose(40)) for k in range(5)]
    bench = spark.createDataFrame(items + items, "item_id long, text string")
    long = prose(60_000) + " " + items[3][1] + " " + prose(60_000)
    rows = [(1, long), (2, items[0][1]), (2, prose(50)), (None, items[4][1]), (None, prose(30)), (3, items[0][1])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    whole = sorted(decontaminate.decontaminate(frame, bench).collect(), key=str)
    left = Counter(decontaminate.without_contaminated(frame, bench).collect())
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 100)
    assert sorted(decontaminate.decontaminate(frame, bench).collect(), key=str) == whole
    assert Counter(decontaminate.without_contaminated(frame, bench).collect()) == left
    assert Counter((r.doc_id, r.contaminated) for r in whole) == Counter(
        [(1, True), (2, True), (2, False), (None, True), (None, False), (3, True)]
    )
    assert left == Counter([(2, rows[2][1]), (None, rows[4][1])])


def test_alignment_and_lemma():
    rng = random.Random(4)
    for _ in range(150):
        pattern = "".join(rng.choice("abcde ") for _ in range(decontaminate.WINDOW))
        region = list(pattern)
        for _ in range(rng.randint(0, decontaminate.EDITS)):
            k = rng.randrange(len(region))
            region[k : k + 1] = rng.choice(["", "z", region[k] + "y"])
        text = "".join(rng.choice("abcde ") for _ in range(rng.randrange(15))) + "".join(region) + "xyz"
        points, parts = decontaminate.code_points(text), decontaminate.code_points(pattern)
        least, _ = decontaminate.aligned(parts, points, -30, 30)
        assert least == brute.edits(pattern, text)
        index = decontaminate.BenchmarkIndex([(1, pattern)])
        assert bool(decontaminate.regions(index, points)) == (least <= decontaminate.EDITS)


def test_quality_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    scored = quality.classify(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert (scored.predicted == scored.quality).mean() > 0.97
    assert (scored[scored.quality == 1].predicted == 1).mean() > 0.99


def test_a_labelled_id_that_repeats_is_learnt_from_once(spark):
    docs = spark.range(3000).select((F.col("id") % 2).alias("doc_id"), F.concat(F.lit("t"), F.col("id")).alias("text"))
    labels = spark.createDataFrame([(0, 1), (1, 0), (0, 1), (0, 0)], "doc_id long, quality int")
    found = quality.labelled_sample(docs, labels.where(~quality.held_out())).collect()
    assert len(found) <= 2


def test_quality_edge_cases(spark, docs, rows, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (8, 0, 0), (3, 1, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    got = quality.classify(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert all(0 <= r.score <= 1 for r in quality.classify(docs, labels.limit(0)).collect())
    assert quality.classify(no_docs, labels).collect() == []


def test_warc_round_trip(spark, tmp_path):
    page = "<p>é" + "x" * 1200
    pages = [(1, "http://a/1", page), (2, "http://a/2 x", page), (9, None, page), (3, "u", "small"), (4, "u", "small"),
             (5, "u", None), (None, "u", page), (6, "u", "y" * 999), (7, "u", "y" * 999), (9, None, page)]
    frame = spark.createDataFrame([(*p, "z") for p in pages], "page_id long, url string, html string, newest string")
    folder = f"file://{tmp_path}/w"
    manifest = warc_bundles.write_bundles(frame, folder, bundle_bytes=200, frame_bytes=1500)
    got = {(r.page_id, r.record_type, r.refers_to) for r in warc_bundles.read_bundles(manifest, folder).collect()}
    assert got == {(1, "revisit", 9), (2, "revisit", 9), (9, "response", None), (3, "response", None), (4, "response", None),
                   (5, "response", None), (None, "response", None), (6, "response", None), (7, "response", None)}
    for entry in manifest.where("page_id in (3, 4, 6)").collect():
        fields, block = warc_bundles.read_record(folder, entry.bundle, entry.frame_offset, entry.offset)
        assert block == (b"y" * 999 if entry.page_id == 6 else b"small") and fields["X-Page-ID"] == str(entry.page_id)
    assert warc_bundles.round_trip(frame.limit(0), f"file://{tmp_path}/none").collect() == []


def test_warc_records_share_frames(spark, tmp_path):
    """Frames hold many records, a long one ends its frame, and places agree with the seek table."""
    html = F.when(F.col("id") == 30, F.repeat(F.lit("long "), 100_000)).otherwise(F.concat(F.lit("<p>same words, "), "id"))
    pages = spark.range(0, 90, 1, 2).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), html.alias("html"))
    sizes = {}
    for frame_bytes in (1, 5000):
        folder = f"file://{tmp_path}/frames{frame_bytes}"
        rows = warc_bundles.write_bundles(pages, folder, frame_bytes=frame_bytes).collect()
        assert sorted(r.page_id for r in rows) == list(range(90))
        for name in {r.bundle for r in rows}:
            bundle = (tmp_path / f"frames{frame_bytes}" / name).read_bytes()
            frames = warc_bundles.read_seek_table(bundle)
            sizes[frame_bytes] = sizes.get(frame_bytes, 0) + len(bundle)
            held = [sum(r.bundle == name and r.frame == k for r in rows) for k in range(len(frames))]
            assert min(held) >= 1 and (max(held) == 1) == (frame_bytes == 1)
            for r in (r for r in rows if r.bundle == name):
                assert frames[r.frame][0] == r.frame_offset and r.offset + r.n_bytes <= frames[r.frame][2]
        for r in rows:
            fields, block = warc_bundles.read_record(folder, r.bundle, r.frame_offset, r.offset)
            assert fields["X-Page-ID"] == str(r.page_id) and len(block) == int(fields["X-Payload-Length"])
    assert sizes[5000] < sizes[1] / 2
    with pytest.raises(ValueError, match="whole"):
        warc_bundles.record_at(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nshort\r\n\r\n", 0)


def test_warc_bundles_are_read_by_many_tasks(spark, tmp_path):
    pages = spark.range(0, 400, 1, 20).select(
        F.col("id").alias("page_id"), F.lit("u").alias("url"), F.repeat(F.md5(F.col("id").cast("string")), F.lit(40)).alias("html")
    )
    folder = f"file://{tmp_path}/many"
    manifest = warc_bundles.write_bundles(pages, folder, bundle_bytes=20_000, frame_bytes=2_000)
    assert manifest.select("bundle").distinct().count() >= 14
    got = warc_bundles.read_bundles(manifest, folder).select(F.spark_partition_id().alias("task")).groupBy("task").count()
    assert got.count() >= 5 and got.agg(F.sum("count")).first()[0] == 400


def check_packing(got, capacity):
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def test_packing(docs, rows, no_docs):
    import zlib

    import numpy as np
    from tokenizers import Tokenizer

    got = packing.pack(docs, catalog.word_bpe()).collect()
    tokenizer = Tokenizer.from_file(catalog.word_bpe())
    expected = Counter()
    for doc, t in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        for k, a in enumerate(range(0, len(ids), 2048)):
            part = ids[a : a + 2048]
            expected[doc, k, a, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == expected
    assert check_packing(got, 2048) <= -(-sum(r.length for r in got) // 2048) + 1
    assert packing.pack(no_docs, catalog.word_bpe()).collect() == []


@pytest.mark.parametrize("joined", [1, 3, 256])
def test_words_are_encoded_alike_alone_and_together(rows, prose, joined, monkeypatch):
    from tokenizers import Tokenizer

    import numpy as np

    monkeypatch.setattr(packing, "JOINED", joined)
    texts = [t or "" for _, t in rows] + ["\u00e9\u00e9 \U0001f600\U0001f600x \u4e2d\u6587", "a" * 3000, "\x00 \x01a", prose(400)]
    coder, whole = packing.WordTokenizer(catalog.word_bpe()), Tokenizer.from_file(catalog.word_bpe())
    got = coder.ids([t.encode() for t in texts])
    for t, ids in zip(texts, got):
        assert np.frombuffer(ids, coder.kind).tolist() == whole.encode(t, add_special_tokens=False).ids


def test_ids_of_32_bits_stay(spark):
    import numpy as np

    for kind in ("<u2", "<u4"):
        rows = [(k, np.arange(n, dtype=kind).tobytes(), n) for k, n in enumerate([3, 1, 5])]
        frame = spark.createDataFrame([(k, 0, 0, n, b) for k, b, n in rows], packing.PIECES).repartition(1)
        for r in packing.widened(frame).collect():
            assert np.frombuffer(r.ids, "<u4").tolist() == list(range(r.length))


def test_salted_ranks_pack_alike(docs, monkeypatch):
    monkeypatch.setattr(packing, "RANK_ROWS", 1)
    check_packing(packing.pack(docs, catalog.word_bpe(), 64).collect(), 64)


def test_plan_is_close_to_best_fit():
    import numpy as np

    rng = np.random.default_rng(3)
    for lengths in (np.minimum(2048, rng.lognormal(6.4, 0.8, 20000).astype(int) + 1), rng.integers(1, 2048, 5000)):
        histogram = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True))))
        rows = packing.packing_plan(histogram, 2048)
        n = max(base + (last - first) // copies for _, first, last, copies, base, _ in rows)
        left = np.bincount(lengths, minlength=2049)
        fitted = sum(c for _, c in packing.best_fit(left, 2048, []))
        assert n <= 1.005 * fitted
        assert Counter({a: n for a, n in histogram.items()}) == Counter(
            {k: max(r[2] for r in rows if r[0] == k) for k in histogram}
        )


def test_nnls():
    import numpy as np

    rng = np.random.default_rng(0)
    columns = np.array([(a, b, c) for a in range(8) for b in range(a + 1) for c in range(-1, b + 1)])
    goal, weight = rng.integers(0, 50, 8).astype(float), np.ones(8)
    x = packing.nnls(columns, goal, weight)
    full = np.zeros((8, len(columns)))
    for j, rows in enumerate(columns):
        for r in rows[rows >= 0]:
            full[r, j] += 1
    rest = goal - full @ x
    assert (x >= 0).all() and (full.T @ rest <= 1e-5).all() and np.abs((full.T @ rest)[x > 0]).max() < 1e-5


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_sql(spark, small, name):
    with connect(small) as con:
        assert differences(catalog.QUERIES[name](spark, small), con, catalog.SQL[name]) == []


def test_packed_sequences_can_be_filled(docs, rows):
    from tokenizers import Tokenizer

    tokenizer, sequences, texts = Tokenizer.from_file(catalog.word_bpe()), {}, {}
    got = packing.packed_pieces(docs, catalog.word_bpe(), 64).collect()
    for r in got:
        ids = [int.from_bytes(r.ids[k : k + 4], "little") for k in range(0, len(r.ids), 4)]
        assert len(ids) == r.length
        sequences.setdefault(r.sequence_id, {}).update(enumerate(ids, r.offset))
        if r.doc_id != 12:  # is there twice
            texts.setdefault(r.doc_id, []).extend((r.start + k, i) for k, i in enumerate(ids))
    assert sum(map(len, sequences.values())) == sum(r.length for r in got)
    assert all(sorted(s) == list(range(len(s))) and len(s) <= 64 for s in sequences.values())
    for doc, t in rows:
        if doc != 12:
            assert [i for _, i in sorted(texts[doc])] == [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
