"""Exact duplicates, SimHash and repeated passages against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from tidemark.llm import common, exact_dedup, simhash, suffix_dedup


def rows_of(frame):
    return [(r["doc_id"], (r["text"] or "").encode()) for r in frame.select("doc_id", "text").collect()]


def by_id(row):
    return (row[0] is None, row[0] or 0, *row[1:])


# -- exact ---------------------------------------------------------------------------------------------


def exact_by_hand(rows):
    classes = defaultdict(list)
    for doc_id, text in rows:
        classes[bytes(c for c in text if c not in b" \t\n\x0b\x0c\r")].append((doc_id, text))
    out = []
    for norm, members in classes.items():
        keep = min(members, key=lambda r: (-len(r[1].decode()), r[0] is None, r[0] or 0))[0]
        sha = hashlib.sha256(norm).digest()
        out.extend((doc_id, sha, keep, len(members), doc_id == keep) for doc_id, _ in members)
    return Counter(out)


@pytest.mark.parametrize("budget", [64 << 20, 1000])
def test_exact_duplicates(spark, small, odd, monkeypatch, budget):
    classes = exact_dedup.duplicate_classes
    monkeypatch.setattr(exact_dedup, "duplicate_classes", lambda docs: classes(docs, budget))
    for docs in (small, odd, odd.limit(0)):
        found = Counter((r[0], bytes(r[1]), *r[2:]) for r in exact_dedup.exact_duplicates(docs).collect())
        assert found == exact_by_hand(rows_of(docs))


def test_trie_keeps_every_string():
    draw = random.Random(3)
    keys = [bytes(draw.choices(b"ab", k=draw.randrange(12))) for _ in range(500)]
    trie, expected, spilt = exact_dedup.PatriciaTrie(), {}, []
    for i, key in enumerate(keys):
        trie.insert(key, (-draw.randrange(3), False, i))
    assert trie.size == exact_dedup.weight(trie.root)
    spilt.extend(trie.spill())
    assert trie.size == exact_dedup.weight(trie.root)
    found = [*spilt, *trie.drain()]
    assert Counter(keys) == Counter({k: n for k, _, n in found})
    assert expected == {}


def test_copies_leave_with_all_columns(odd):
    left = exact_dedup.without_copies(odd)
    assert left.columns == odd.columns
    ids = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in left.collect())
    # neither the null id nor the second row of id 3 stays: their text is that of row 3
    assert ids == [(False, i) for i in (2, 3, 7, 8, 9, 10, 11, 12, 13, 77)]


def test_what_stays_is_decided_row_by_row(spark, documents):
    """A repeated id keeps only the texts that the operator keeps for it, and rows without an id go like others."""
    docs = documents([(1, "longest  text  here"), (1, "other words"), (2, "other   words"), (None, "a b c d"), (None, "a  b c d"), (5, "ab  cd")], _kept="k", row="r", id="i")
    left = exact_dedup.without_copies(docs)
    assert left.columns == docs.columns
    assert Counter((r.doc_id, r.text, r._kept, r.row) for r in left.collect()) == Counter(
        [(1, "longest  text  here", "k", "r"), (2, "other   words", "k", "r"), (None, "a  b c d", "k", "r")]
    )
    words = " ".join(f"w{i}" for i in range(60))
    near = documents([(4, words), (2, words.replace("w7 ", "w7  ")), (None, words), (None, "x y z"), (None, "x  y z"), (9, words + "!"), (9, "q r s")], _kept="k", fp="f", digest="d")
    single = simhash.one_of_each(near)
    assert single.columns == near.columns
    found = sorted((r.doc_id is None, r.doc_id or 0, r.text.split()[0], r.digest) for r in single.collect())
    linked = {i for i, r in components_by_hand([(i, fingerprint_by_hand(t.encode())) for i, t in enumerate([words, words + "!"])]).items() if r == i}
    expected = [(False, 2, "w0", "d"), (False, 9, "q", "d"), (True, 0, "x", "d")] + ([(False, 9, "w0", "d")] if len(linked) == 2 else [])
    assert found == sorted(expected)


# -- simhash -------------------------------------------------------------------------------------------


def fingerprint_by_hand(text, k=3):
    words = text.lower().split()
    shingles = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_by_hand(pairs):
    parent = {i: i for i, _ in pairs}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in pairs:
        for j, b in pairs:
            if i < j and (a ^ b).bit_count() <= 3:
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return {i: root(i) for i in parent}


def test_near_duplicates(small, documents):
    near = [" ".join(f"w{i % 41}x{i}" if i != cut else "new" for i in range(400)) for cut in range(30)]
    for docs in (small, documents(near)):
        found = {r["doc_id"]: (r["fp"] % (1 << 64), r["component_id"]) for r in simhash.near_duplicates(docs).collect()}
        prints = [(i, fingerprint_by_hand(t)) for i, t in rows_of(docs)]
        roots = components_by_hand(prints)
        assert found == {i: (fp, roots[i]) for i, fp in prints}
        assert len(set(roots.values())) < len(roots)


def test_hot_probing_keys_lose_no_link(spark, monkeypatch):
    """Fingerprints of which most share half their bits, so that keys are widened down to the last class."""
    monkeypatch.setattr(simhash, "HOT", 4)
    draw = random.Random(12)
    values = set()
    for top in (draw.getrandbits(32), 0):
        seeds = [top << 32 | draw.getrandbits(32) for _ in range(60)]
        for seed in seeds:
            values |= {seed, seed ^ 1 << draw.randrange(32), seed ^ 7 << draw.randrange(30), seed ^ 15 << draw.randrange(29)}
    values |= {draw.getrandbits(64) for _ in range(50)}
    frame = spark.createDataFrame([(simhash.signed(v),) for v in values], "fp long")
    found = {r["node"]: r["root"] for r in common.connected_components(simhash.linked(frame)).collect()}
    roots = components_by_hand([(simhash.signed(v), v) for v in values])
    assert {v: found.get(v, v) for v in roots} == roots


def test_near_duplicates_of_odd_texts(odd):
    rows = simhash.near_duplicates(odd).collect()
    prints = Counter((r["doc_id"], r["fp"] % (1 << 64)) for r in rows)
    assert prints == Counter((i, fingerprint_by_hand(t)) for i, t in rows_of(odd))
    assert {r["component_id"] for r in rows if r["fp"] == 0} == {0}
    assert simhash.near_duplicates(odd.limit(0)).collect() == []
    assert simhash.one_of_each(odd).columns == odd.columns


@pytest.mark.parametrize("n", [100, 10**6, 10**10])
def test_no_pair_escapes_the_probes(n):
    draw = np.random.default_rng(n)
    together = draw.uniform(0.2, 0.3, (64, 64)) * n
    together[np.diag_indices(64)] = draw.uniform(0.2, 0.8, 64) * n
    allocation = simhash.allocate(n, together, 3)[1]
    assert sorted(b for bits, _ in allocation for b in bits) == list(range(64))
    assert sum(t + 1 for _, t in allocation) == 4
    masks = simhash.probe_masks(allocation)
    for _ in range(300):
        out = sum(1 << int(b) for b in draw.choice(64, 3, replace=False))
        assert any(out & mask == 0 for mask in masks)


def test_thresholds_follow_the_number_of_documents():
    def parts(n):
        together = np.full((64, 64), n / 4.0)
        together[np.diag_indices(64)] = n / 2
        return sum(t >= 0 for _, t in simhash.allocate(n, together, 3)[1])

    assert parts(10**4) == 4
    assert parts(10**10) < parts(10**4)


def test_star_edges_join_what_links():
    draw = np.random.default_rng(5)
    values = np.unique(draw.integers(0, 1 << 12, 300)).astype(np.int64) << 40
    edges = simhash.star_edges(values, 1)
    pairs = [(int(v), int(v)) for v in values]
    parent = dict(pairs)
    for a, b in edges:
        parent[b] = a
    assert len(edges) == sum(k != v for k, v in parent.items())
    for a in parent:
        for b in parent:
            if (a ^ b).bit_count() <= 1:
                assert parent[a] == parent[b]


def test_components_of_long_chains(spark):
    chain = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (103, 101), (101, 102)]
    frame = spark.createDataFrame(chain, "a long, b long")
    found = {r["node"]: r["root"] for r in common.connected_components(frame).collect()}
    assert found == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 104)}


# -- repeated passages ---------------------------------------------------------------------------------


def passages_by_hand(rows, length=50):
    first = {}
    for doc_id, text in sorted(rows, key=by_id):
        for p in range(len(text) - length + 1):
            first.setdefault(text[p : p + length], (doc_id is None, doc_id or 0))
    out = []
    for doc_id, text in rows:
        gone = np.zeros(len(text) + 1, bool)
        for p in range(len(text) - length + 1):
            if first[text[p : p + length]] < (doc_id is None, doc_id or 0):
                gone[p : p + length] = True
        edges = np.flatnonzero(np.diff(gone.astype(int), prepend=0))
        spans = list(zip(edges[::2].tolist(), edges[1::2].tolist()))
        out.append((doc_id, len(text), tuple(spans), bytes(c for c, g in zip(text, gone) if not g)))
    return Counter(out)


def passages(docs, **how):
    rows = suffix_dedup.repeated_passages(docs, **how).collect()
    return Counter((r["doc_id"], r["n_bytes"], tuple((s["start"], s["end"]) for s in r["spans"]), bytes(r["kept"])) for r in rows)


def test_repeated_passages(small, odd):
    assert passages(small, chunk_rows=17) == passages_by_hand(rows_of(small))
    assert passages(odd, chunk_rows=3) == passages_by_hand(rows_of(odd))
    assert passages(odd, chunk_bytes=300) == passages_by_hand(rows_of(odd))
    assert passages(odd.limit(0)) == Counter()


def test_passages_of_few_letters(documents):
    """Texts of two letters repeat at every offset, within documents and across."""
    draw = random.Random(8)
    block = "".join(draw.choices("ab", k=300))
    texts = []
    for _ in range(60):
        a, b = sorted(draw.sample(range(300), 2))
        texts.append("".join(draw.choices("ab", k=draw.randrange(60))) + block[a:b] + "ab" * draw.randrange(40))
    docs = documents(texts)
    assert passages(docs, chunk_rows=7) == passages_by_hand(rows_of(docs))
    assert passages(docs, length=20, chunk_rows=7) == passages_by_hand(rows_of(docs), 20)


@pytest.mark.parametrize("hot", [0, 8])
def test_passages_around_hot_triggers(small, odd, documents, hot):
    for docs, length in ((small, 50), (odd, 50), (documents(licensed(80)), 50), (documents(licensed(80)), 20)):
        assert passages(docs, length=length, chunk_rows=7, hot_phrases=hot) == passages_by_hand(rows_of(docs), length)


def test_a_file_holds_any_number_of_chunks(documents, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "MAX_FILES", 3)
    docs = documents(licensed(80))
    assert passages(docs, chunk_rows=2) == passages_by_hand(rows_of(docs))


def licensed(n):
    """Texts that share one line, each with words of its own before and after it."""
    draw = random.Random(21)
    line = "Licensed to all under the terms of the common licence, see the file."
    return [f"{draw.getrandbits(300):x}{line}{draw.getrandbits(300 + i % 3):x}" for i in range(n)]


def test_no_bucket_holds_all_phrases_of_a_trigger():
    """What one unit of work gets of a line that every document has follows the chunks, not the documents."""
    ids, texts = np.arange(600), [t.encode() for t in licensed(600)]
    chunks = [suffix_dedup.Chunk(ids[i : i + 100].tolist(), texts[i : i + 100], 50, 1) for i in range(0, 600, 100)]
    sent = [[*c.trigger_messages()][0] for c in chunks]
    table = pa.table({"items": [m[1] for m in sent], "extra": [m[2] for m in sent]})
    for chunk, bits in zip(chunks, suffix_dedup.shared_bits(table, 64)):
        chunk.keep_shared({0: bits})
    cold = Counter(int(k) for c in chunks for k in c.cold_keys)
    assert not cold or max(cold.values()) <= 64
    windows = Counter(bytes(w) for c in chunks for w in c.windows)
    assert len(windows) > 600
    assert max(windows.values()) == len(chunks)


def test_each_window_has_a_trigger():
    draw = np.random.default_rng(2)
    for data in (draw.integers(0, 3, 4000), np.zeros(400), draw.integers(0, 256, 4000)):
        at, _ = suffix_dedup.triggers(data.astype(np.uint8), 50)
        assert all(((at >= p) & (at <= p + 34)).any() for p in range(len(data) - 49))


def test_stretches_of_a_text_have_its_triggers(monkeypatch):
    draw = np.random.default_rng(3)
    for data in (draw.integers(0, 3, 3001), np.zeros(400), draw.integers(0, 256, 3000)):
        whole = suffix_dedup._triggers(data.astype(np.uint8), 50)
        for stretch in (1, 64, 999, 3000):
            monkeypatch.setattr(suffix_dedup, "STRETCH", stretch)
            at, keys = suffix_dedup.triggers(data.astype(np.uint8), 50)
            assert (at.tolist(), keys.tolist()) == (whole[0].tolist(), whole[1].tolist())


def test_text_stays_whole_characters(documents):
    same = "é" * 40
    docs = documents(["a" + same, "b" + same + "è" * 30, None], kept="k", rest="r")
    left = suffix_dedup.without_repeats(docs)
    assert left.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in left.collect()} == {0: "a" + same, 1: "b" + "è" * 29, 2: ""}  # one è loses its first byte
    assert {r["kept"] for r in left.collect()} == {"k"}
