import random
import time

import numpy as np
import public_tokenizers
import pytest
import regex
from llm.cases import ODD_ROWS, rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from trendlake.llm import _bpe, bpe_codec, token_counts
from trendlake.llm._bpe import BpeTable
from trendlake.llm._pretokens import splitter
from trendlake.llm.bpe_codec import decode, decode_ids, encode, encode_texts
from trendlake.llm.token_counts import count_tokens, normalised, whole_tokens

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def table():
    return BpeTable.load(BYTE)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTE)


def samples():
    random.seed(4)
    alphabet = "aaabcé ÉΣσς'\n\t  .,İ12٣中😀\x1c\xa0 "
    out = ["".join(random.choice(alphabet) for _ in range(random.randint(0, 60))) for _ in range(800)]
    return out + ["<|endoftext|>", "a<|endoftext|>b<|endoftext|><|startoftext|>x", " " * 3000 + "a", "a" * 5000, "abab" * 3000, "ΑΣ ΑΣΑ Σ", "it's I'LL we're", ""]


def test_ids_and_round_trip_as_the_library(table, library):
    texts = samples()
    ids, counts = encode_texts(table, texts)
    ends = np.cumsum(counts)
    for text, n, end in zip(texts, counts, ends, strict=True):
        mine = ids[end - n : end]
        assert mine.tolist() == library.encode(text, add_special_tokens=False).ids
        assert decode_ids(table, mine) == text


def test_any_ids_decode_as_the_library(table, library):
    random.seed(5)
    for _ in range(200):
        ids = [random.randrange(table.base) for _ in range(random.randint(0, 30))]
        assert decode_ids(table, np.array(ids, int)) == library.decode(ids, skip_special_tokens=False)
    assert decode_ids(table, np.array([-1, table.base, 64])) == library.decode([64])


def one_by_one(pairs, symbols):
    """The merge of the lowest rank, leftmost first, one at a time."""
    symbols = list(symbols)
    while True:
        ranks = [(pairs[p][0], i) for i, p in enumerate(zip(symbols, symbols[1:], strict=False)) if p in pairs]
        if not ranks:
            return symbols
        _, i = min(ranks)
        symbols[i : i + 2] = [pairs[symbols[i], symbols[i + 1]][1]]


def test_rounds_equal_single_merges_for_any_merge_table():
    rng = np.random.default_rng(6)
    for _ in range(30):
        base, chosen = 9, rng.permutation(81)[:25]
        keys = np.sort(chosen)
        ranks = rng.permutation(len(keys))
        made = rng.integers(0, base, len(keys))
        first = np.full(base, np.iinfo(np.int64).max)
        np.minimum.at(first, keys // base, ranks)
        np.minimum.at(first, keys % base, ranks)
        table = BpeTable(np.empty(base, object), {}, base, keys, ranks, made, first[made] < ranks, np.arange(base), np.arange(base))
        pairs = {(int(k) // base, int(k) % base): (int(r), int(m)) for k, r, m in zip(keys, ranks, made, strict=True)}
        words = [rng.integers(0, base, rng.integers(1, 12)) for _ in range(60)]
        flat, lengths = table.merge(np.concatenate(words), np.array([len(w) for w in words]))
        got = np.split(flat, np.cumsum(lengths)[:-1])
        assert [g.tolist() for g in got] == [one_by_one(pairs, w.tolist()) for w in words]


def test_latin_texts_split_as_all_others():
    random.seed(9)
    letters = [chr(c) for c in [*range(0x250), 0x300, 0x4E2D, 0xA0]] + ["'s", "'ll", "  ", " a"] * 20
    texts = ["".join(random.choice(letters[: 0x80 if i % 2 else None]) for _ in range(60)) for i in range(2000)]
    texts += [f"a{c}b {c}{c} 1{c}\n{c} " for c in letters]
    for pattern in (bpe_codec.PATTERN, token_counts.PATTERN):
        mine, general = splitter(pattern), regex.compile(pattern).findall
        assert [mine(t) for t in texts] == [general(t) for t in texts]


def test_cache_may_be_emptied_and_forgets_long_words(table, library, monkeypatch):
    monkeypatch.setattr(_bpe.WordCache, "ENTRIES", 50)
    monkeypatch.setattr(_bpe.WordCache, "_of", {})
    texts = samples()
    ids, counts = encode_texts(table, texts)
    assert counts.tolist() == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    assert all(len(w) <= 64 for c in _bpe.WordCache._of.values() for w in c.found)


def test_columns_of_odd_rows(spark, odd, empty, clashing, library):
    got = decode(encode(clashing(odd, "token_ids", "decoded"), BYTE), BYTE)
    want = sorted(((i, library.encode(t or "", add_special_tokens=False).ids, t or "") for i, t, _, _ in ODD_ROWS), key=repr)
    assert [(i, list(ids), t) for i, ids, t in rows(got, "doc_id", "token_ids", "decoded")] == want
    assert got.columns.count("token_ids") == 1 and "TEXT" in got.columns
    assert decode(encode(empty, BYTE), BYTE).collect() == []
    odd_ids = spark.createDataFrame([(None,), ([],), ([64, None, 65],)], "token_ids array<int>")
    assert [r.decoded for r in decode(odd_ids, BYTE).orderBy(F.size("token_ids")).collect()] == [None, "", "ab"]


def test_files_with_other_settings_are_refused(tmp_path):
    text = open(BYTE, encoding="utf-8").read().replace('"dropout":null', '"dropout":0.1').replace('"dropout": null', '"dropout": 0.1')
    (tmp_path / "t.json").write_text(text, encoding="utf-8")
    with pytest.raises(ValueError, match="dropout"):
        BpeTable.load(str(tmp_path / "t.json"))


def test_counts_as_the_library(spark, odd, empty, clashing):
    library = Tokenizer.from_file(WORD)
    texts = [t for _, t, _, _ in ODD_ROWS] + samples() + [None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = count_tokens(clashing(df, "n_tokens", "N_Bytes"), WORD, limit=20)
    want = [(i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 20) for i, t in enumerate(texts)]
    assert rows(got, "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(want, key=repr)
    assert count_tokens(empty, WORD).collect() == []


def test_whole_tokens_are_proved():
    library, table = Tokenizer.from_file(WORD), BpeTable.load(WORD)
    whole = sorted(whole_tokens(WORD, table))
    assert len(whole) > 30_000
    assert all(len(e.ids) == 1 for e in library.encode_batch(whole, add_special_tokens=False))


def test_lower_case_letter_by_letter():
    library = Tokenizer.from_file(WORD)
    for text in ["ΑΣ", "ΑΣ ΣΑΣ", "İI", "ǅ", "éÉ", "KK", "ꟋꟜ", "ẞß"]:
        assert normalised(text) == library.normalizer.normalize_str(text)


def every_code_point():
    """All code points, each between letters, digits, marks and itself, some at a time."""
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    shown = [f"{c}a W{c}1 e{c}́ {c}{c}Σ" for c in points]
    return ["\n".join(shown[i : i + 512]) for i in range(0, len(shown), 512)]


def test_every_code_point_counts_as_in_the_library():
    library, table = Tokenizer.from_file(WORD), BpeTable.load(WORD)
    texts = every_code_point()
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert token_counts.count_texts(table, whole_tokens(WORD, table), texts) == want


def test_every_code_point_encodes_as_in_the_library(table, library):
    texts = every_code_point()
    ids, counts = encode_texts(table, texts)
    ends = np.cumsum(counts)
    for n, end, encoding in zip(counts, ends, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert ids[end - n : end].tolist() == encoding.ids


@pytest.mark.parametrize("size", [_bpe.LONG_WORD, _bpe.LONG_WORD + 1, 20_000])
def test_long_words_merge_as_in_the_library(table, library, size):
    random.seed(size)
    words = ["".join(random.choices("etaoinshr", k=size)), "a" * size, "ab" * (size // 2), "é" * size]
    ids, counts = table.word_ids(["short", *words, "x"])
    ends = np.cumsum(counts)
    for word, n, end in zip(["short", *words, "x"], counts, ends, strict=True):
        assert ids[end - n : end].tolist() == library.encode(word, add_special_tokens=False).ids


def test_a_word_of_a_million_letters_takes_seconds(table, library):
    word = "".join(random.choices("etaoinshrdlu", k=1_000_000))
    begun = time.perf_counter()
    ids, _ = table.word_ids([word])
    assert time.perf_counter() - begun < 20  # some 4 s; a round a merge would take half an hour
    assert ids.tolist() == library.encode(word, add_special_tokens=False).ids


def test_one_very_long_word_in_a_table(spark):
    df = spark.createDataFrame([(1, "q" * 200_000), (2, "zy" * 100_000 + " a")], "doc_id bigint, text string")
    library = Tokenizer.from_file(WORD)
    want = [(i, len(library.encode(t, add_special_tokens=False).ids)) for i, t in ((1, "q" * 200_000), (2, "zy" * 100_000 + " a"))]
    assert rows(count_tokens(df, WORD), "doc_id", "n_tokens") == want
