import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.cases import documents, odd_rows, words
from tidemill.llm.bpe import Encoder, Vocabulary, decode_bpe, encode_bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_texts_like_the_library(library):
    draw = random.Random(1)
    parts = [*"abcdefghTHE '1234#$\n\t", "'s", "'re", "'LL", "<|endoftext|>", "<|startoftext|>", "é", "É", "é", "Σ",
             "İ", "ﬁ", "漢", " ", "\x1c", "\x85", "😀", "aaaa", "x" * 40, "3.14", "_", "--"]
    texts = ["", " ", *("".join(draw.choice(parts) for _ in range(draw.randint(0, 60))) for _ in range(3000))]
    encoder = Encoder(Vocabulary(PATH))
    for at in range(0, len(texts), 500):
        ids, sizes = encoder.batch(texts[at : at + 500])
        expected = [e.ids for e in library.encode_batch(texts[at : at + 500], add_special_tokens=False)]
        assert sizes.tolist() == [len(e) for e in expected]
        assert ids.tolist() == [i for e in expected for i in e]


def test_a_full_cache_changes_nothing(library, monkeypatch):
    monkeypatch.setattr("tidemill.llm.bpe.CACHED_PIECES", 50)
    encoder = Encoder(Vocabulary(PATH))
    for seed in range(8):
        ids, _ = encoder.batch([words(seed, 40)])
        assert ids.tolist() == library.encode(words(seed, 40), add_special_tokens=False).ids


def test_ranks_follow_their_parts():
    """Merging all occurrences of the lowest pair at once is right if no merge makes a
    pair of lower rank."""
    v = Vocabulary(PATH)
    made = dict(zip(v.merged.tolist(), v.ranks.tolist()))
    assert all(
        max(made.get(k >> 32, -1), made.get(k & 0xFFFFFFFF, -1)) < r for k, r in zip(v.keys.tolist(), v.ranks.tolist())
    )


def test_odd_rows(spark, library):
    rows = odd_rows()
    df = documents(spark, rows)
    encoded = encode_bpe(df, PATH)
    assert sorted(encoded.columns) == sorted(df.columns)  # the column ids is replaced
    got = decode_bpe(encoded, PATH).select("doc_id", "text", "ids", "decoded").collect()
    assert len(got) == len(rows)
    for r in got:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == ids and r.decoded == library.decode(ids, skip_special_tokens=False)


def test_decoding_in_the_same_pass(spark):
    df = documents(spark, odd_rows())
    one = encode_bpe(df, PATH, decoded="key").select("doc_id", "ids", "key")
    two = decode_bpe(encode_bpe(df, PATH), PATH, text="key").select("doc_id", "ids", "key")
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))


def test_odd_ids(spark):
    rows = [(1, [0, None, -5, 10**9]), (2, None), (3, [])]
    got = decode_bpe(spark.createDataFrame(rows, "doc_id long, ids array<int>"), PATH).collect()
    assert [r.decoded for r in sorted(got)] == ["!", "", ""]


def test_empty_table(spark):
    assert encode_bpe(documents(spark, []).limit(0), PATH).count() == 0
