"""Encoders against their libraries, packing, Huffman files, on odd texts and edge cases."""

import os
import random
import subprocess
import sys
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from helpers import DOCUMENTS, LONG, documents

from reqsift.llm import cuts, huffman, packing, pieces, tokens
from reqsift.session import scratch_dir

RNG = random.Random(7)
ODD = ["", "   ", "\n\n foo", "it's <|endoftext|> x<|endoftext|>", "x\ty z\x1cw \x85 q", "İstanbul ſs ﬁ ª º ´e", "<s> <0x0A> ▁▁ x"]
ODD += ["foo. 12 34 abc123 d'été l'eau O'Neil", "日本語 の テキスト, ok", " a", "a ", "ΣΑΣ Σ", " x  y", "÷×a÷b", "é" * 300]
ODD += ["".join(RNG.choice("ab'é \n\t.|ÀΣ1٣̈ <>|_日▁") for _ in range(RNG.randint(0, 40))) for _ in range(800)]
ODD += [" ".join(ODD), LONG[:20_000]]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_piece_encoder(name, monkeypatch):
    encoder = tokens.PieceEncoder(public_tokenizers.path(name))
    want = [e.ids for e in encoder.tokenizer.encode_batch(ODD, add_special_tokens=False)]
    assert [x.tolist() for x in encoder.encode(ODD)] == want
    assert [x.tolist() for t in ODD for x in encoder.encode([t])] == want
    monkeypatch.setattr(tokens.slices, "__defaults__", (400,))
    assert [x.tolist() for x in encoder.encode(ODD)] == want
    monkeypatch.setattr(tokens, "CACHE_BYTES", 0)
    assert [x.tolist() for x in encoder.encode(ODD)] == want


def test_cuts_without_hashes():
    texts = ["ab c ab. ab", "", "ab"]
    a = cuts.cut(texts, b" \n", keep=True)
    assert [a.distinct[i] for i in a.which] == [b"ab", b" c", b" ab", b".", b" ab", b"ab"]
    assert a.counts.tolist() == [5, 0, 1]


def test_sentencepiece_equals_the_library():
    codec = pieces.PieceCodec(public_tokenizers.path("piece_bpe_32k.model"))
    library = codec.model.processor
    want = [library.encode(t) for t in ODD]
    assert [x.tolist() for x in codec.encode(ODD)] == want
    for text, ids in zip(ODD, want):
        # In slices of any size, committed as the paths converge.
        assert codec.search(library.normalize(text), 5) == ids
        assert codec.decode(ids) == library.decode(ids)


def test_streaming_window_stays_small():
    codec = pieces.PieceCodec(public_tokenizers.path("piece_bpe_32k.model"))
    search = pieces.StreamingViterbi(codec.model)
    text, most, ids = codec.model.processor.normalize(LONG[:30_000]), 0, []
    for at in range(0, len(text), 100):
        ids += search.feed(text[at : at + 100])
        most = max(most, len(search.nodes))
    assert ids + search.finish() == codec.model.processor.encode(LONG[:30_000])
    assert most < 400


def _message(fields):
    def varint(n):
        out = b""
        while True:
            n, low = n >> 7, n & 127
            out += bytes([low | (128 if n else 0)])
            if not n:
                return out

    out = b""
    for number, value in fields:
        if isinstance(value, int):
            out += varint(number << 3) + varint(value)
        elif isinstance(value, float):
            out += varint(number << 3 | 5) + np.float32(value).tobytes()
        else:
            out += varint(number << 3 | 2) + varint(len(value)) + value
    return out


def test_unigram_paths_score_as_the_library(tmp_path):
    """The same pieces as a unigram model with scores of a unigram kind: equal ids, or ties in score."""
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        data = file.read()
    fields = []
    for number, value in pieces._fields(data):
        if number == 1:
            piece = dict(pieces._fields(value))
            score = float(-3 - np.log1p(abs(np.frombuffer(piece[2], "<f4")[0])))
            value = _message([(1, piece[1]), (2, score), *([(3, piece[3])] if 3 in piece else [])])
        elif number == 2:
            value = _message([(3, 1), (4, 32000), (35, 1)])
        fields.append((number, value))
    path = tmp_path / "unigram.model"
    path.write_bytes(_message(fields))
    codec = pieces.PieceCodec(str(path))
    assert codec.model.algorithm == 1
    score = lambda ids: sum(codec.model.scores[i] for i in ids)
    same = 0
    for text in ODD:
        want, got = codec.model.processor.encode(text), codec.search(codec.model.processor.normalize(text), 7)
        same += want == got
        assert codec.decode(got) == codec.decode(want)
        assert score(got) == pytest.approx(score(want), rel=1e-5)
    assert same > 0.95 * len(ODD)


def test_short_words_are_searched_depth_first():
    """The path of the whole lattice, over fewer nodes."""
    model = pieces.codec("piece_bpe_32k.model").model
    words = {w for t in [*ODD, LONG] for w in model.processor.normalize(t).replace("▁", " ▁").split(" ")}
    words |= {"▁" + "".join(RNG.choice("aeinrstlobc") for _ in range(RNG.randint(1, 30))) for _ in range(500)}
    deep = whole = 0
    for word in words:
        lattice = pieces.StreamingViterbi(model)
        lattice.text = word
        ids = lattice._run(len(word), len(word))
        search = pieces.StreamingViterbi(model)
        assert search.finish(word) == ids + lattice._ids(len(lattice.text))
        if 8 < len(word) <= pieces.COMMIT_EVERY // 2:
            deep, whole = deep + len(search.nodes), whole + len(lattice.nodes)
    assert deep < 0.8 * whole


def test_many_texts_are_decoded_at_once():
    codec, model = pieces.codec("piece_bpe_32k.model"), pieces.codec("piece_bpe_32k.model").model
    texts = [[RNG.choice([RNG.randrange(400), RNG.randrange(len(model.pieces))]) for _ in range(RNG.randint(0, 30))] for _ in range(300)]
    kinds = {pieces._CONTROL: lambda p: b"", pieces._BYTE: lambda p: bytes([int(p[3:5], 16)]), pieces._UNKNOWN: lambda p: " ⁇ ".encode()}
    spelled = [kinds.get(k, str.encode)(p) for p, k in zip(model.pieces, model.kinds)]
    want = [b"".join(spelled[i] for i in t).decode(errors="replace").replace("▁", " ").removeprefix(" ") for t in texts]
    assert codec.decode_all(np.array(sum(texts, [])), np.array([len(t) for t in texts])) == want
    assert [codec.decode(t) for t in texts] == want


def test_tables_for_cutting_are_made_where_texts_are_cut():
    """Not on import: the driver and the workers that only decode don't need the 64 MB."""
    code = "from reqsift.llm import cuts, pieces; assert not cuts._both_powers.cache_info().currsize; cuts.cut(['a b'], b' ', False)"
    code += "; assert cuts._both_powers.cache_info().currsize"
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)


def test_sentencepiece_rows(spark):
    df = documents(spark)
    encoded = pieces.encode(df)
    back = pieces.decode(encoded.withColumn("clash", encoded["ids"]))
    texts = Counter((r[0], r[1] or "") for r in DOCUMENTS)
    assert Counter((r["doc_id"], r["text"]) for r in back.collect()) == texts
    assert pieces.encode(documents(spark, [])).count() == 0
    assert pieces.decode(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")).first()["text"] == ""


@pytest.mark.parametrize("capacity", [1, 2, 10, 64])
def test_plan_is_whole_and_tight(capacity):
    rng = np.random.default_rng(capacity)
    for rows in (0, 1, 7, 400):
        lengths = Counter(rng.integers(1, capacity + 1, rows).tolist())
        plan = packing.plan(lengths, capacity)
        used = Counter()
        for pattern, times in plan:
            assert sum(pattern) <= capacity
            for x in pattern:
                used[x] += times
        assert used == lengths
        least = -(-sum(k * v for k, v in lengths.items()) // capacity)
        assert sum(t for _, t in plan) <= 1.25 * least + 1


def test_plan_fills_gaps_exactly():
    assert packing.plan({7: 5, 3: 5}, 10) == [((7, 3), 5)]
    assert packing.plan({6: 2, 3: 2, 1: 2}, 10) == [((6, 3, 1), 2)]
    assert packing.plan({4: 1, 3: 1, 2: 1, 1: 1}, 10) == [((4, 3, 2, 1), 1)]


def _best_fit(lengths, capacity):
    """Sequences of best fit decreasing, piece by piece."""
    gaps, used = Counter(), 0
    for length in sorted(lengths, reverse=True):
        for _ in range(lengths[length]):
            gap = min((g for g, n in gaps.items() if n and g >= length), default=None)
            used += gap is None
            if gap is not None:
                gaps[gap] -= 1
            gaps[(capacity if gap is None else gap) - length] += 1
    return used


def test_best_fit_of_many_at_a_time_is_that_of_one_by_one():
    rng = random.Random(3)
    for _ in range(200):
        capacity = rng.choice([5, 10, 30, 100])
        lengths = Counter({rng.randint(1, capacity): rng.choice([1, 1, 2, 3, 7, 50]) for _ in range(rng.randint(1, 12))})
        whole, best = (Counter(), Counter())
        for made, plan in ((whole, packing.exact_plan(lengths, capacity)), (best, packing.best_fit_plan(lengths, capacity))):
            for pattern, times in plan:
                assert times > 0 and sum(pattern) <= capacity
                for length in pattern:
                    made[length] += times
        assert whole == best == lengths
        assert sum(t for _, t in packing.best_fit_plan(lengths, capacity)) == _best_fit(lengths, capacity)
        assert sum(t for _, t in packing.plan(lengths, capacity)) <= _best_fit(lengths, capacity)


def test_best_fit_of_a_huge_histogram_ends():
    lengths = {n: 10**10 + n for n in range(1, 65)}
    plan = packing.plan(lengths, 64)
    assert sum(t for _, t in plan) <= -(-sum(n * c for n, c in lengths.items()) // 64) * 1.02


def test_index_of_sums():
    """Ways to make each sum, against all combinations, while counts fall."""
    from itertools import combinations_with_replacement

    rng = np.random.default_rng(5)
    sums = packing._Sums(np.concatenate(([0], rng.integers(0, 5, 20))))
    for _ in range(12):
        sums._index()
        for k, made in ((2, sums.pairs), (3, sums.triples)):
            there = Counter(
                sum(c) for c in combinations_with_replacement(range(1, 21), k) if all(sums.left[x] >= n for x, n in Counter(c).items())
            )
            assert [round(made[s]) for s in range(21)] == [there[s] for s in range(21)]
        for gap in range(1, 21):
            found = sums.exact(gap)
            assert (found is not None) == bool(sums.left[gap] or sums.pairs[gap] > 0.5 or sums.triples[gap] > 0.5)
            assert found is None or sum(found) == gap and all(sums.left[x] >= n for x, n in Counter(found).items())
        length = int(rng.choice(np.flatnonzero(sums.left)))
        sums.take(np.array([length]), np.ones(1, dtype=np.int64))


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_never_more_sequences_than_best_fit_and_few_more_than_the_least(scale):
    import duckdb
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = duckdb.sql(f"SELECT coalesce(text, '') FROM '/root/testdata/{scale}/documents.parquet'").fetchall()
    lengths = Counter()
    for (text,) in texts:
        n = len(library.encode(text, add_special_tokens=False).ids) + 1
        lengths[1024] += n // 1024
        lengths[n % 1024] += n % 1024 > 0
    lengths = Counter({k: v for k, v in lengths.items() if v})
    used = sum(t for _, t in packing.exact_plan(lengths, 1024))
    assert used <= _best_fit(lengths, 1024) and used <= -(-sum(k * v for k, v in lengths.items()) // 1024) + 2


def test_pack_rows(spark):
    # `length`, `piece` and `start` of the input are other columns: only id and text are taken.
    made = packing.token_pieces(documents(spark), capacity=64, with_ids=True)
    packed = packing.pack(made, 64).collect()
    assert Counter(r["doc_id"] for r in packed if r["piece"] == 0) == Counter(r[0] for r in DOCUMENTS)
    places = {}
    for r in packed:
        assert r["length"] == len(r["ids"]) and zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack(packing.token_pieces(documents(spark, []))).count() == 0
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(1, 0, 65)], "doc_id long, piece int, length long"), 64)


def test_code_lengths_are_optimal_and_limited():
    counts = np.zeros(300, dtype=np.int64)
    counts[:40] = [int(1.6**i) + 1 for i in range(40)]
    for limit in (6, 8, 20):
        lengths = huffman.code_lengths(counts, limit)
        assert lengths.max() <= limit and sum(2.0 ** -int(x) for x in lengths if x) == 1
    import heapq

    heap = sorted(int(c) for c in counts if c)
    cost = 0
    while len(heap) > 1:
        a = heapq.heappop(heap) + heapq.heappop(heap)
        cost += a
        heapq.heappush(heap, a)
    assert int((counts * huffman.code_lengths(counts, 40)).sum()) == cost
    assert huffman.code_lengths(np.array([0, 0, 5])).tolist() == [0, 0, 1]
    with pytest.raises(ValueError):
        huffman.code_lengths(np.ones(5, dtype=np.int64), 2)


@pytest.mark.parametrize("size", [0, 1, 127, 128, 129, 1000])
def test_blocks_round_trip(size):
    ids = np.random.default_rng(size).zipf(1.3, size).clip(0, 65535).astype(np.uint16)
    lengths = huffman.code_lengths(np.bincount(ids, minlength=1 << 16))
    block = huffman.pack_block(ids, huffman.canonical_codes(lengths), lengths)
    back = huffman.unpack_blocks([block, block], huffman.decode_table(lengths))
    assert [b.tolist() for b in back] == [ids.tolist()] * 2


def test_token_file_rows(spark, monkeypatch):
    monkeypatch.setattr(huffman, "BLOCK_IDS", 300)  # documents over several blocks; tasks of this session see it too
    encode = tokens.encoder("word_bpe_49k.json").encode
    df = documents(spark)
    path = scratch_dir(spark, "file")
    huffman.write_token_file(df, path)
    got = huffman.read_token_file(spark, path, with_ids=True).orderBy("start").collect()
    texts = Counter((r[0], tuple(encode([r[1] or ""])[0].tolist()) + (2,)) for r in DOCUMENTS)
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in got) == texts
    at = 0
    for r in got:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"])
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        at += r["n_tokens"]
    ids = [r["doc_id"] for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))


def test_empty_token_file(spark):
    path = scratch_dir(spark, "file")
    huffman.write_token_file(documents(spark, []), path)
    assert huffman.read_token_file(spark, path).count() == 0
