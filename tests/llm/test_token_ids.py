"""Pieces, shards and packing against the libraries run on each whole text."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from marinelake.llm.packing import CAPACITY, op5_best_fit_packing, pack_documents, plan_packing
from marinelake.llm.pieces import decode_pieces, encode_pieces, op8_sentencepiece, piece_digests
from marinelake.llm.tokens import public_tokenizer
from marinelake.llm.wavelet import WaveletMatrix, find_tokens, op7_token_ids, read_shards, write_shards

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def bytes_model():
    return Tokenizer.from_file(public_tokenizer("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def piece_model():
    return SentencePieceProcessor(model_file=public_tokenizer("piece_bpe_32k.model"))


def ids_of(model, text):
    return [*model.encode(text or "", add_special_tokens=False).ids, 0]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def bag(rows):
    return Counter(tuple(r) for r in rows)


def test_pieces_equal_the_library(spark, odd, piece_model):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for df, result in ((odd, piece_digests(odd)), (docs, op8_sentencepiece(spark, SF))):
        expected = []
        for row in df.collect():
            ids = piece_model.encode(row["text"] or "")
            expected.append((row["doc_id"], len(ids), sha(",".join(map(str, ids))), sha(piece_model.decode(ids))))
        assert bag(result.collect()) == bag(expected)


def test_pieces_round_trip(odd, empty):
    texts = {r["doc_id"]: r["text"] for r in odd.where("doc_id in (1, 5, 7)").collect()}
    back = {r["doc_id"]: r["text"] for r in decode_pieces(encode_pieces(odd)).collect()}
    assert all(back[i] == t for i, t in texts.items())
    assert piece_digests(empty).count() == 0


@pytest.mark.parametrize("n, most", [(0, 5), (1, 1), (513, 1), (5000, 60000), (70000, 300)])
def test_wavelet_matrix(n, most):
    ids = np.random.default_rng(n).integers(0, most, n).astype(np.uint32)
    lengths = np.array([n // 3, n - n // 3])
    matrix, names, back = WaveletMatrix.from_bytes(WaveletMatrix.build(ids).to_bytes([None, 7], lengths))
    assert names == [None, 7] and back.tolist() == lengths.tolist()
    assert (matrix.decode() == ids).all()
    for token in {*ids[:3].tolist(), 0, most - 1, 1 << 20}:
        at = np.flatnonzero(ids == token)
        assert matrix.count(token) == len(at) and matrix.occurrences(token).tolist() == at.tolist()
        for j in {0, len(at) // 2, len(at) - 1} if len(at) else ():
            assert matrix.select(token, j) == at[j]
        assert matrix.rank(token, n // 2) == (ids[: n // 2] == token).sum()
    for i in range(0, n, max(1, n // 7)):
        assert matrix.access(i) == ids[i]


def _in_order(rows):
    return sorted(rows, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))


def test_shards_read_back(spark, odd, empty, bytes_model, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    manifest = write_shards(odd, str(tmp_path / "odd"))
    for df, result in ((odd, read_shards(manifest, str(tmp_path / "odd"))), (docs, op7_token_ids(spark, SF))):
        rows = _in_order(df.collect())
        got = sorted(result.collect(), key=lambda r: r["start"])
        assert [r["doc_id"] for r in got] == [r["doc_id"] for r in rows]
        assert bag((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == bag(
            (r["doc_id"], len(ids := ids_of(bytes_model, r["text"])), crc(ids)) for r in rows
        )
        assert [r["start"] for r in got] == [0, *np.cumsum([r["n_tokens"] for r in got]).tolist()][:-1]
    word = bytes_model.encode(" word", add_special_tokens=False).ids[0]
    found = find_tokens(manifest, str(tmp_path / "odd"), [word]).count()
    assert found == sum(ids_of(bytes_model, r["text"]).count(word) for r in odd.collect())
    nothing = str(tmp_path / "none")
    assert read_shards(write_shards(empty, nothing), nothing).count() == 0


def test_packing_keeps_every_id_once(spark, odd, empty, bytes_model):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for df, result in ((odd, pack_documents(odd)), (docs, op5_best_fit_packing(spark, SF))):
        rows, expected = result.collect(), []
        for row in df.collect():
            ids, start, piece = ids_of(bytes_model, row["text"]), 0, 0
            while start < len(ids):
                length = (len(ids) - start) % CAPACITY or CAPACITY
                expected.append((row["doc_id"], piece, start, length, crc(ids[start : start + length])))
                start, piece = start + length, piece + 1
        assert bag(r[:5] for r in rows) == bag(expected)
        sequences = {}
        for r in rows:
            sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        for placed in sequences.values():
            end = 0
            for offset, length in sorted(placed):
                assert offset == end
                end += length
            assert end <= CAPACITY
        least = -(-sum(r["length"] for r in rows) // CAPACITY)
        assert len(sequences) <= 1.03 * least + 1
    assert pack_documents(empty).count() == 0


@pytest.mark.parametrize("kind", ["uniform", "skewed", "middle"])
def test_plan_is_near_best_fit_decreasing(kind):
    rng = np.random.default_rng(3)
    draw = {
        "uniform": lambda: rng.integers(1, 2049, 3000),
        "skewed": lambda: np.clip(rng.lognormal(6.3, 0.9, 3000), 1, 2048).astype(int),
        "middle": lambda: rng.integers(700, 1100, 3000),
    }[kind]()
    bins = []
    for x in sorted(draw.tolist(), reverse=True):
        fits = [i for i, g in enumerate(bins) if g >= x]
        if fits:
            bins[min(fits, key=bins.__getitem__)] -= x
        else:
            bins.append(2048 - x)
    runs, n = plan_packing(Counter(draw.tolist()))
    assert n <= 1.005 * len(bins) + 1
    assert Counter({x: int(runs[runs[:, 0] == x][:, 2].sum()) for x in set(draw.tolist())}) == Counter(draw.tolist())


def test_a_kept_encoder_encodes_a_word_once(bytes_model, monkeypatch):
    """The next task of a worker does not encode again the words of the task before."""
    import pyarrow as pa

    from marinelake.llm.tokens import kept_byte_level

    path = public_tokenizer("byte_bpe_50k.json")
    texts = ["a grün  wörd", " word 日本 grün word", "", "one two two\nthree", "x " + "two " * 50 + "end"]
    first = kept_byte_level(path).encode(pa.array(texts))
    encoder, asked = kept_byte_level(path), []
    inner = encoder.inner.encode
    monkeypatch.setattr(encoder.inner, "encode", lambda words: asked.extend(words) or inner(words))
    ids, offsets = encoder.encode(pa.array(texts + ["one unseen"]))
    assert asked == ["unseen"]
    assert (ids[: len(first[0])] == first[0]).all()
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [ids_of(bytes_model, t)[:-1] for t in texts + ["one unseen"]]
