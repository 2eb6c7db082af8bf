"""Range coder and token files: exact round trips, the tokenizer itself, damaged blocks."""

import zlib

import numpy as np
import pytest

from tests.conftest import SF001
from tests.llm.cases import ODD, by_id, odd_docs, texts


def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    t.encode_special_tokens = True
    return t


def test_blocks_round_trip():
    from loanmart.llm.range_coder import decode_blocks, encode_blocks
    rng = np.random.default_rng(0)
    blocks = [rng.integers(0, 65535, n) for n in (0, 1, 5, 100, 3000)] + [
        np.zeros(500, int), np.tile([1, 2, 3, 70, 49000], 200), np.minimum(rng.zipf(1.2, 4000), 65534), np.full(3, 65534)]
    coded = encode_blocks(blocks)
    for a, b in zip(blocks, decode_blocks(coded, [len(b) for b in blocks])):
        assert a.tolist() == b.tolist()
    assert len(coded[6]) < 60 and len(coded[7]) < 2 * len(blocks[7])        # what repeats is predicted
    alone = decode_blocks([coded[7]], [len(blocks[7])])[0]                   # blocks do not need each other
    assert alone.tolist() == blocks[7].tolist()
    assert encode_blocks([]) == [] and decode_blocks([], []) == []


def test_damaged_segments_are_noticed():
    from loanmart.llm.token_files import pack_segment, unpack_segment
    ids = np.minimum(np.random.default_rng(1).zipf(1.3, 9000), 49000).astype(np.uint16)
    data = pack_segment(ids)
    assert unpack_segment(data).tolist() == ids.tolist() and unpack_segment(pack_segment(ids[:0])).tolist() == []
    for at in (0, 20, len(data) - 40):
        bad = bytearray(data)
        bad[at] ^= 64
        with pytest.raises(ValueError):
            unpack_segment(bytes(bad))
    with pytest.raises(ValueError):
        unpack_segment(data[:-1])


def plain(rows):
    t, out, start = tokenizer(), [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_files_of_the_tables(spark, monkeypatch):
    from loanmart.llm import token_files as T
    monkeypatch.setattr(T, "TASK_BYTES", 100_000)
    monkeypatch.setattr(T, "SEGMENT_IDS", 20_000)
    assert by_id(T.op8_token_files(spark, SF001).collect()) == by_id(plain(texts(SF001)))


def test_files_of_odd_rows(spark, tmp_path):
    import public_tokenizers
    from loanmart.llm.token_files import read_ids, write_ids
    name = public_tokenizers.path("word_bpe_49k.json")
    write_ids(odd_docs(spark), str(tmp_path / "a"), name)
    got = [tuple(r) for r in read_ids(spark, str(tmp_path / "a")).collect()]
    want = plain(ODD)
    assert sorted((str(g[0]), g[2], zlib.crc32(g[3])) for g in got) == sorted((str(w[0]), w[2], w[3]) for w in want)
    at = 0
    for i, start, n, _ in sorted(got, key=lambda g: g[1]):                   # places follow one another, ids ascend
        assert start == at
        at += n
    order = [g[0] for g in sorted(got, key=lambda g: g[1])]
    assert order == sorted(order, key=lambda x: (x is None, x or 0))
    write_ids(odd_docs(spark).limit(0), str(tmp_path / "b"), name)
    assert read_ids(spark, str(tmp_path / "b")).count() == 0


def test_too_many_ids_are_refused(tmp_path):
    from loanmart.llm.token_files import WordIds
    from tokenizers import Tokenizer, models
    Tokenizer(models.WordLevel({str(i): i for i in range(65_536)}, unk_token="0")).save(str(tmp_path / "large.json"))
    with pytest.raises(ValueError, match="65536 ids"):
        WordIds(str(tmp_path / "large.json"))


def test_words_encode_like_whole_texts():
    """Case, punctuation, apostrophes, accents, control and special strings, against the tokenizer on the text."""
    import public_tokenizers
    from loanmart.llm.token_files import WordIds
    t, words = tokenizer(), WordIds(public_tokenizers.path("word_bpe_49k.json"))
    rng = np.random.default_rng(5)
    bits = ["don't", "DON'T!!", "x'", "'s", "it's.", "Été,", "mot»,", "«mot", "ß.", "İstanbul!", "ΣΑΣ.", "e\u0301.", "\u0301,", "\x01", "a\x01b",
            "<|endoftext|>", "|>", "12,", "a1.", "日本。", "日本,", "...", "!!", "word|", "the&&&", "ﬁ.", "K.", "—dash—", "\u00a0", "\x85", "a\u200bb,"]
    texts_ = [" ".join(rng.choice(bits, 12)) for _ in range(400)] + ["".join(rng.choice(bits, 6)) for _ in range(400)] + ["", " ", "\t\n"]
    for text, got in zip(texts_, words.encode(texts_)):
        assert np.frombuffer(got, "<u2").tolist() == t.encode(text, add_special_tokens=False).ids, repr(text)
    for _, text in texts(SF001):
        assert np.frombuffer(words.encode([text])[0], "<u2").tolist() == t.encode(text, add_special_tokens=False).ids


def test_special_literals_are_the_tokens_of_the_unchanged_tokenizer(spark, tmp_path):
    import public_tokenizers
    from loanmart.llm.token_files import read_ids, write_ids
    from tokenizers import Tokenizer
    name = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(name)
    rng = np.random.default_rng(6)
    bits = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|EndOfText|>", "<|endoftext", "|>", "Été", "é", "́", "don't", "x!", " ", "\n", "\x01", ".", "Σ"]
    cases = ["<|endoftext|>", "a<|endoftext|>b <|startoftext|> c", "<|ENDOFTEXT|>", ""] + ["".join(rng.choice(bits, 9)) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(cases)), "doc_id bigint, text string").repartition(3)
    write_ids(df, str(tmp_path / "a"), name)
    got = {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in read_ids(spark, str(tmp_path / "a")).collect()}
    assert got[1][1] in (49406, 49407)
    for i, text in enumerate(cases):
        assert got[i] == t.encode(text, add_special_tokens=False).ids + [1], repr(text)


def test_ids_that_no_context_predicts_cost_their_share():
    """Sixteen scattered ids in turn by chance: four bits each; coded by class and raw bits they took sixteen."""
    from loanmart.llm.token_files import pack_segment, unpack_segment
    ids = (30_000 + 1_111 * np.random.default_rng(2).integers(0, 16, 30_000)).astype(np.uint16)
    data = pack_segment(ids)
    assert unpack_segment(data).tolist() == ids.tolist()
    assert 8 * len(data) < 6 * len(ids)


def test_carries_and_blocks_of_many_lengths():
    from loanmart.llm.range_coder import decode_blocks, encode_blocks, frequencies
    rng = np.random.default_rng(3)
    blocks = [np.where(rng.random(n) < 0.97, 65_534 - n % 3, rng.integers(0, 65_535, n)) for n in range(700)]
    for share in (None, frequencies(np.bincount(np.concatenate(blocks), minlength=65_535))):
        got = decode_blocks(encode_blocks(blocks, share), [len(b) for b in blocks], share)
        assert all(a.tolist() == b.tolist() for a, b in zip(blocks, got))


def test_words_are_cut_at_punctuation_and_encoded_once(monkeypatch):
    import public_tokenizers
    from loanmart.llm import token_files as T
    t, words = tokenizer(), T.WordIds(public_tokenizers.path("word_bpe_49k.json"))
    words.encode(["word. word, (word) WORD!", "word.word;word"])
    assert sorted(words.words.to_pylist()) == [b"!", b"(", b")", b",", b".", b";", b"word"]
    rng = np.random.default_rng(8)
    bits = ["a", "Zy", "s", "re", "'", ".", "=", "<", "|", "-", "̸", "́", "é", "É", "ß", "Ø", "×", "µ", "ª", "7", "日", " ", "\x1c"]
    cases = ["".join(rng.choice(bits, 9)) for _ in range(3000)]
    for small in (1 << 30, 2000):                       # also with a table of words that overflows
        monkeypatch.setattr(T, "CACHE_BYTES", small)
        for i in range(0, len(cases), 500):
            for text, got in zip(cases[i:i + 500], words.encode(cases[i:i + 500])):
                assert np.frombuffer(got, "<u2").tolist() == t.encode(text, add_special_tokens=False).ids, repr(text)
