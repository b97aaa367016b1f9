import hashlib
import random
from collections import Counter

import brute
import numpy as np
import pytest

from tallymart.llm import components, exact_dedup, simhash, substring_dedup, suffix_dedup


def answers(df):
    return Counter(tuple(r) for r in df.collect())


def test_exact_dedup(docs, rows):
    def body(t):
        return (t or "").encode().translate(None, b" \t\n\x0b\x0c\r")

    groups = {}
    for doc, t in rows:
        groups.setdefault(body(t), []).append((doc is None, -len(t or ""), doc or 0, doc))
    expected = Counter()
    for doc, t in rows:
        g = groups[body(t)]
        keep = min(g)[3]
        expected[doc, keep, len(g), doc == keep, hashlib.sha256(body(t)).hexdigest()] += 1
    assert answers(exact_dedup.exact_dedup(docs)) == expected


def test_patricia_trie_splits_edges():
    trie = exact_dedup.PatriciaTrie()
    words = [b"", b"roman", b"romane", b"romulus", b"rubens", b"r", b"roman"]
    for k, w in enumerate(words):
        trie.terminal(w).append(k)
    assert dict(trie.items()) == {b"": [0], b"roman": [1, 6], b"romane": [2], b"romulus": [3], b"rubens": [4], b"r": [5]}


def test_small_tries_give_the_same(docs, monkeypatch):
    expected = answers(exact_dedup.exact_dedup(docs))
    for name in ("LOCAL_BYTES", "TRIE_BYTES", "BATCH_BYTES"):
        monkeypatch.setattr(exact_dedup, name, 64)
    assert answers(exact_dedup.exact_dedup(docs)) == expected


def test_simhash(docs, rows):
    got = simhash.simhash_dedup(docs).collect()
    known = [(d, brute.fingerprint(t)) for d, t in dict.fromkeys(rows) if d is not None]
    roots = brute.components(known, 2)
    marks = dict(known)
    assert len(got) == len(rows)
    for doc, mark, component in got:
        if doc is not None:
            assert (int(mark, 16), component) == (marks[doc], roots[doc])


@pytest.mark.parametrize("bucket", [1, 64])
@pytest.mark.parametrize("distance", [2, 4])
def test_links_are_complete(spark, monkeypatch, bucket, distance):
    """Also with nearly all partition values crowded."""
    rng = random.Random(bucket)
    centres = [rng.getrandbits(64) for _ in range(12)]
    values = {0}
    for c in centres:
        for _ in range(12):
            values.add(c ^ sum({1 << rng.randrange(64) for _ in range(rng.randrange(4))}))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    frame = spark.createDataFrame([(v,) for v in signed], "mark long")
    roots = {r.node: r.root for r in components.components(simhash.links(frame, distance)).collect()}
    expected = brute.components(sorted((v, v & (1 << 64) - 1) for v in signed), distance)
    assert {v: roots.get(v, v) for v in signed} == expected


def test_thresholds_cover_the_distance():
    assert simhash.allocate([[0, 5, 9, 9], [0, 100, 100, 100], [0, 4, 7, 8]], 0) == [-1, -1, 2]
    common, n = simhash.np.eye(64) * 50, 100
    for distance in (2, 4):
        groups, chosen = simhash.plan(common, n, distance)
        assert sorted(b for g in groups for b in g) == list(range(64))
        assert sum(chosen) == distance - len(groups) + 1


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in components.components(edges).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}


@pytest.mark.parametrize("window", [35, 8])
def test_substring_dedup(docs, rows, window):
    assert answers(substring_dedup.substring_dedup(docs, window)) == Counter(brute.substring(rows, window))


@pytest.mark.parametrize("window, heavy", [(100, 4096), (100, 2), (60, 4096)])
def test_suffix_dedup(docs, rows, window, heavy):
    got = answers(suffix_dedup.suffix_dedup(docs, window, heavy))
    assert got == Counter(brute.suffix(rows, window))


def test_suffix_order():
    rng = random.Random(2)
    for kinds in ("a", "ab", "abcdefgh"):
        strings = ["".join(rng.choice(kinds) for _ in range(rng.randint(1, 40))).encode() for _ in range(9)]
        number, start, prefix = suffix_dedup.suffix_order(strings)
        found = [strings[k][a:] for k, a in zip(number, start)]
        assert found == sorted(found) and len(found) == sum(map(len, strings)) + len(strings)
        for k in range(1, len(found)):
            shared = len(__import__("os").path.commonprefix(found[k - 1 : k + 1]))
            assert prefix[k] == shared


@pytest.mark.parametrize(
    "run", [exact_dedup.exact_dedup, simhash.simhash_dedup, substring_dedup.substring_dedup, suffix_dedup.suffix_dedup]
)
def test_empty_table(no_docs, run):
    assert run(no_docs).collect() == []


def test_suffix_runs_of_repeated_windows():
    """Exactly the windows that occur twice among the strings are left, and keys stay together."""
    chance, window = random.Random(5), 30
    line = bytes(chance.choices(b"ab", k=70))
    strings = [bytes(chance.choices(b"ab", k=chance.randrange(30, 50))) for _ in range(40)]
    strings += [line, line[3:60], b"x" + line[:33] + b"y" + line[5:40], b"z" * 45, line[:30]]
    places = [(k, a, s[a : a + window]) for k, s in enumerate(strings) for a in range(len(s) - window + 1)]
    times = Counter(w for _, _, w in places)
    found = suffix_dedup.repeated_runs(strings, window)
    left = [(k, a) for k, x, y in zip(*found) for a in range(x, y)]
    assert left == [(k, a) for k, a, w in places if times[w] > 1]
    assert all(len(part) == 0 for part in suffix_dedup.repeated_runs([], window))
    keys = np.array([1, 1, 1, 2, 5, 5, 9], np.uint64)
    assert list(suffix_dedup.key_groups(keys, 2)) == [(0, 3), (3, 6), (6, 7)]
    assert list(suffix_dedup.key_groups(keys[:0], 2)) == []


def test_suffix_strings_of_a_common_line_are_split(prose):
    """A line between differing neighbours gives a string per document, but no large group."""
    import itertools

    import pyarrow as pa
    import zstandard

    line, heavy, window = "a line of more than a hundred bytes that very many of the documents hold, and each of them with other neighbours", 40, 100
    rows = [(k, prose(20) + line + prose(20)) for k in range(150)] + [(None, line + prose(9)), (7, prose(20) + line)]
    chunks = []
    for number, part in enumerate(itertools.batched(rows, 51)):
        texts = [t.encode() for _, t in part]
        row = {"chunk": number, "ids": [d for d, _ in part], "sizes": [len(t) for t in texts]}
        chunks.append(row | {"blob": zstandard.ZstdCompressor().compress(b"".join(texts))})
    sd, lists = suffix_dedup, pa.list_(pa.int64())

    def batches(rows, **more):
        kinds = {"chunk": pa.int64(), "ids": lists, "sizes": lists, "blob": pa.binary()} | more
        return pa.Table.from_pylist(rows, pa.schema(list(kinds.items()))).to_batches()

    keys = pa.Table.from_batches(sd._emit_grams(window, 40, 1)(batches(chunks)))
    merge = [sd._added] if hasattr(sd, "_added") else []
    said = sd.answers.__globals__["answer"](keys, sd._marks(heavy), *merge).to_pylist()
    for row in chunks:
        row["grams"] = [{k: r[k] for k in ("bucket", "n", "bits")} for r in said if r["chunk"] == row["chunk"]]
    bits = pa.list_(pa.struct([("bucket", pa.int32()), ("n", pa.int64()), ("bits", pa.binary())]))
    pieces = pa.Table.from_batches(sd._emit_strings(window, 40, 1)(batches(chunks, grams=bits)))
    of_key = Counter()
    for row in pieces.to_pylist():
        if row["keys"] is not None:
            of_key.update(sd._unpacked(row["keys"], "u8").tolist())
    assert of_key and max(of_key.values()) < heavy
    spans = sd._construct(window)(pieces).to_pylist()
    for row in chunks:
        row["spans"] = [r["spans"] for r in spans if r["chunk"] == row["chunk"]]
        del row["grams"]
    removed = Counter()
    for out in sd._remove(batches(chunks, spans=pa.list_(pa.binary()))):
        removed.update((r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"])) for r in out.to_pylist())
    assert removed == Counter(r[:4] for r in brute.suffix(rows, window))


def test_suffix_equal_runs_are_ordered_once(prose, monkeypatch):
    """Of a line between differing neighbours one run is inserted, not one per document."""
    import pyarrow as pa

    sd, window = suffix_dedup, 100
    line = "a line of more than a hundred bytes that very many of the documents hold, and each of them with other neighbours"
    rows = [(k, prose(20) + line[k % 3 :] + prose(20)) for k in range(150)] + [(None, line), (7, line + prose(9) + line)]
    texts, inserted, order = [t.encode() for _, t in rows], [], sd.suffix_order
    monkeypatch.setattr(sd, "chunk_rows", list)
    monkeypatch.setattr(sd, "suffix_order", lambda strings: inserted.extend(strings) or order(strings))
    row = {"chunk": 0, "ids": [d for d, _ in rows], "sizes": [len(t) for t in texts], "data": b"".join(texts)}
    keys = pa.Table.from_batches(sd._emit_grams(window, 40, 1)([row]))
    said = sd.answers.__globals__["answer"](keys, sd._marks(sd.HEAVY), sd._added).to_pylist()
    pieces = pa.Table.from_batches(sd._emit_strings(window, 40, 1)([row | {"grams": said}]))
    spans = sd._construct(window)(pieces).column("spans").to_pylist()
    assert 0 < len(inserted) < len(rows) // 2
    (out,) = sd._remove([row | {"spans": spans}])
    removed = Counter((r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"])) for r in out.to_pylist())
    assert removed == Counter(r[:4] for r in brute.suffix(rows, window))


def test_later_copies():
    strings, none = [b"ab", b"b", b"ab", b"ab", b"b"], np.zeros(0, np.int64)
    later = suffix_dedup.later_copies(strings, np.array([1, 0, 0, 1, 3]), np.array([5, 0, 9, 2, 0]))
    assert later.tolist() == [True, False, False, True, True]
    assert suffix_dedup.later_copies([], none, none).tolist() == []


@pytest.mark.parametrize("size", [1, 5, 24, 100])
@pytest.mark.parametrize("n", [0, 1, 23, 24, 99, 100, 101, 300])
def test_blocks_change_no_number(monkeypatch, n, size):
    data = np.frombuffer(random.Random(n).randbytes(n), np.uint8)
    whole = suffix_dedup.gram_hashes(data, size)
    monkeypatch.setattr(suffix_dedup, "BLOCK", 7)
    assert suffix_dedup.gram_hashes(data, size).tolist() == whole.tolist()
    found = [int(data[a : a + size].min()) for a in range(n - size + 1)]
    if found:
        assert suffix_dedup.sliding(data, size, True).tolist() == found


@pytest.mark.parametrize("run, window", [(substring_dedup, 8), (suffix_dedup, 60)])
def test_kept_texts_and_spans(docs, rows, run, window):
    """The texts come out, and the spans say what is missing from them."""
    words = run is substring_dedup
    got = (run.substring_texts if words else run.suffix_texts)(docs, window).collect()
    texts = {d: (t or "").encode() for d, t in rows}
    assert len(got) == len(rows) and any(r.spans for r in got)
    for r in got:
        parts = texts[r.doc_id].split() if words else texts[r.doc_id]
        for begin, end in reversed(r.spans):
            assert 0 <= begin < end <= len(parts)
            parts = parts[:begin] + parts[end:]
        assert (b" ".join(parts).decode() if words else parts) == r.kept
    expected = (brute.substring if words else brute.suffix)(rows, window)
    kept = [r.kept.encode() if words else r.kept for r in got]
    digests = Counter((r.doc_id, hashlib.sha256(k).hexdigest()) for r, k in zip(got, kept))
    assert digests == Counter((r[0], r[-1]) for r in expected)
