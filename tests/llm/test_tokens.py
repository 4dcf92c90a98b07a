"""BPE and token counts against the public library, and the separator scan on files of its own."""

import base64
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tidemark.llm import bpe, queries, token_counts
from tidemark.workspace import shared_folder

PATH, PATTERN = public_tokenizers.path(queries.RANKS), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def own():
    with open(PATH, "rb") as file:
        return bpe.encoder(file.read(), PATTERN)


def packed(ids):
    return np.array(ids, "<u4").tobytes()


def test_ids_are_those_of_the_library(library, own):
    draw = random.Random(1)
    texts = ["".join(draw.choices("aehilnorst", k=draw.randrange(1, 40))) for _ in range(300)]
    texts += ["".join(chr(draw.choice([32, 10, 9, 39, draw.randrange(1, 0x3000), 0x1F600])) for _ in range(50)) for _ in range(200)]
    texts += ["", "a" * 5000, "ab" * 3000, "ha" * 999 + "h", "\r\n  x", "x" * 70000, "don't we'll 123 4,5"]
    found = own.encode(texts)
    assert found == [packed(library.encode_ordinary(t)) for t in texts]
    assert [own.decode(ids) for ids in found] == [t.encode() for t in texts]


def test_merges_follow_ranks_that_fall():
    """A merge can make a pair of lower rank, which goes before the other pairs of its bucket."""
    ranks = {bytes([b]): 300 + b for b in range(256)} | {b"ab": 9, b"aba": 2, b"ba": 5, b"bab": 1, b"abab": 0}
    own = bpe.Encoder(ranks, r"\S+")
    library = tiktoken.Encoding("x", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})
    draw = random.Random(4)
    for _ in range(400):
        text = "".join(draw.choices("abc", k=draw.randrange(1, 30)))
        assert own.encode([text])[0] == packed(library.encode_ordinary(text))


def test_known_pieces_are_bounded(own, library, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_HELD", 4000)
    for n in range(5):
        texts = [f"word{n}x{i} and {'y' * 100}" for i in range(20)]
        assert own.encode(texts) == [packed(library.encode_ordinary(t)) for t in texts]
    assert all(len(piece) <= bpe.MAX_PIECE for piece in own.known)
    assert own.held == sum(bpe._PIECE_BYTES + len(piece) + len(ids) for piece, ids in own.known.items()) <= 4000 + 40 * 300


def test_queue_orders_ranks_and_places():
    for ranks in (10, 300, 70_000):
        queue, draw, expected = bpe.RankQueue(ranks), random.Random(ranks), {}
        for _ in range(200):
            rank, place = draw.randrange(ranks), draw.randrange(1000)
            expected.setdefault(rank, []).append(place)
            if rank in queue.buckets:
                queue.buckets[rank].append(place)
            else:
                queue.fill(rank, [place])
        found = [queue.take() for _ in expected]
        assert found == [(rank, sorted(expected[rank])) for rank in sorted(expected)]
        assert queue.take() == (-1, [])


def test_queries(spark, odd, small, library):
    for docs in (odd, small, odd.limit(0)):
        texts = Counter((r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect())
        found = bpe.decoded(bpe.encoded(docs, PATH, PATTERN), PATH, PATTERN).collect()
        expected = Counter()
        for (i, t), n in texts.items():
            expected[i, packed(library.encode_ordinary(t)), t.encode()] += n
        assert Counter((r[0], bytes(r[1]), bytes(r[2])) for r in found) == expected
        counted = token_counts.documents_counted(docs, PATH, PATTERN, queries.SEPARATOR).collect()
        lengths = Counter()
        for (i, t), n in texts.items():
            lengths[i, len(library.encode_ordinary(t))] += n
        assert Counter(map(tuple, counted)) == lengths


def counted_by_hand(tokens, separator):
    out, start = [], 0
    for at, token in enumerate(tokens):
        if token == separator:
            out.append((len(out), start, at - start, True))
            start = at + 1
    if start < len(tokens):
        out.append((len(out), start, len(tokens) - start, False))
    return out


@pytest.mark.parametrize("width", [2, 4])
def test_scan_stitches_blocks(spark, width, monkeypatch):
    """Documents over many blocks, separators at block ends, open ends, empty files and broken last tokens."""
    monkeypatch.setattr(token_counts, "RUN", 3)
    draw = np.random.default_rng(width)
    files = {
        "a.tokens": draw.choice([7, 8, 9, 50256], 4000),
        "b.tokens": np.concatenate([np.full(1500, 3), [50256], np.full(700, 3)]),
        "c.tokens": np.array([50256]),
        "d.tokens": np.zeros(0, int),
        "e.tokens": np.full(64, 50256),
        "f.tokens": np.full(500, 1),
    }
    folder = f"{shared_folder(spark)}/scan_{width}"
    system, inside = token_counts.opened(folder)
    system.create_dir(inside)
    for name, tokens in files.items():
        with system.open_output_stream(f"{inside}/{name}") as out:
            out.write(tokens.astype(f"<u{width}").tobytes() + b"\x07" * (name == "f.tokens"))
    found = token_counts.count_tokens(spark, folder, 50256, width, block=33 * width + 1).collect()
    expected = {(name, *row) for name, tokens in files.items() for row in counted_by_hand(tokens, 50256)}
    assert {tuple(r) for r in found} == expected
    assert len(found) == len(expected)


def test_ids_and_separators_must_fit(spark, odd, tmp_path):
    ranks = tmp_path / "ranks"
    lines = [(bytes([b]), b) for b in range(256)] + [(b"ab", 70_000)]
    ranks.write_text("".join(f"{base64.b64encode(t).decode()} {n}\n" for t, n in lines))
    for separator, width, message in ((70_001, 2, "do not fit"), (-1, 4, "do not fit"), (7, 4, "is a token")):
        with pytest.raises(ValueError, match=message):
            token_counts.documents_counted(odd, str(ranks), r"\S+|\s+", separator, width)
    found = token_counts.documents_counted(odd, str(ranks), r"\S+|\s+", 70_001, 4).collect()
    assert len(found) == odd.count() and {r.n_tokens for r in found if r.doc_id == 0} == {0}
    assert token_counts.documents_counted(odd.limit(0), str(ranks), r"\S+|\s+", 70_001, 4).collect() == []
