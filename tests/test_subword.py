"""SFT-1 with a sub-word tokenizer, and SFT-6: against a public implementation and round trips."""

import base64
import random

import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from captally.functions.subword import SubwordTokenizer, read_tokenizer
from captally.operators.sft import assemble_batches, encode, training_examples
from captally.queries import SUBWORD_VOCABULARY

PYTHON_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
TEXTS = [
    "A man's dog isn't here!", "", " ", "\n\n  two\t\tlines \n", "aaaaaaaaaaaaaaaaaaaa aaa", "日本語 élan 🙂🙂 naïve x", "1234567890 $$$ 50%",
    "antidisestablishmentarianism " * 3, "\u0000\u0001  end", "ééééééééé ????????? -----------", "x" * 3000, " leading and trailing ",
]


@pytest.fixture(scope="module")
def public():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(SUBWORD_VOCABULARY, "rb"))}
    return tiktoken.Encoding("own", pat_str=PYTHON_PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def tokenizer(spark):
    return read_tokenizer(spark, SUBWORD_VOCABULARY)


def test_words_as_the_public_encoder(tokenizer, public):
    r = random.Random(1)
    words = ["".join(r.choice("abcdeth  .é日") for _ in range(r.randrange(0, 30))) for _ in range(3000)] + ["ab" * 500, "a" * 999, "the" * 100]
    got = tokenizer.encode_words(pa.array(words)).to_pylist()
    assert got == [public._core_bpe.encode_single_piece(w.encode()) if w else [] for w in words]


def test_texts_as_the_public_encoder(spark, tokenizer, public):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "k int, text string").repartition(3)
    got = {r.k: list(r.ids) for r in encode(df, "text", None, ["k"], tokenizer=tokenizer).collect()}
    assert got == {k: public.encode_ordinary(t) for k, t in enumerate(TEXTS)}
    back = encode(df, "text", None, ["k"], tokenizer=tokenizer).select("k", tokenizer.decode(F.col("ids")).alias("t"))
    assert {r.k: r.t for r in back.collect()} == dict(enumerate(TEXTS))


def test_examples_end_and_pad_with_the_free_id(spark, tokenizer, public):
    caps = spark.createDataFrame([("a", "a dog runs"), ("b", "x " * 50), ("c", "")], "image string, caption string")
    rows = {r.image: r for r in training_examples(caps, "Describe this.", None, 16, tokenizer=tokenizer, mask_eos=False).collect()}
    prompt, ids = public.encode_ordinary("Describe this."), public.encode_ordinary("a dog runs")
    eos = tokenizer.eos
    assert eos == public.n_vocab == 50256
    assert list(rows["a"].input_ids) == prompt + ids + [eos] * (16 - len(ids))
    assert list(rows["a"].labels) == [-100] * len(prompt) + ids + [eos] + [-100] * (15 - len(ids))
    assert list(rows["b"].input_ids) == prompt + public.encode_ordinary("x " * 50)[:16]
    assert sum(rows["c"].attention_mask) == len(prompt) + 1


def test_small_vocabularies():
    with pytest.raises(ValueError, match="single bytes"):
        SubwordTokenizer({b"a": 0})
    tokens = {bytes([b]): b for b in range(256)} | {b"aa": 256, b"ab": 257, b"aab": 258}
    got = SubwordTokenizer(tokens).encode_words(pa.array(["aab", "aaab", "aaaa", "ab", "", "b"])).to_pylist()
    # a a a b: the first two a merge, and "ab" then outranks "aa" + "a".
    assert got == [[258], [256, 257], [256, 256], [257], [], [98]]


def test_batches_hold_matrices(spark):
    rows = [(f"i{k}", [k, k + 1], [1, 0], [-100, k], "ok" if k != 3 else "error") for k in range(11)]
    df = spark.createDataFrame(rows, "image string, input_ids array<int>, attention_mask array<int>, labels array<int>, status string").repartition(3)
    got = assemble_batches(df, 4).orderBy("batch_id").collect()
    order = sorted(f"i{k}" for k in range(11) if k != 3)
    assert [i for b in got for i in b.images] == order and [b.n_examples for b in got] == [4, 4, 2]
    assert [list(x) for b in got for x in b.labels] == [[-100, int(i[1:])] for i in order]
    assert [len(b.input_ids) for b in got] == [4, 4, 2]
    assert assemble_batches(df.select("image")).columns == ["batch_id", "n_examples", "images"]


def test_encoding_joins_nothing_and_keeps_repeated_keys(spark):
    """words are encoded where their text is; rows with equal keys stay one text, word by word."""
    from captally.functions.subword import SubwordTokenizer
    from captally.operators.sft import encode

    tokens = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"abc": 257, b" ab": 258}
    tok = SubwordTokenizer(tokens)
    df = spark.createDataFrame([(1, "abc ab"), (2, ""), (3, None), (4, "x ab\n")], "k long, text string")
    got = encode(df, "text", None, ["k"], tokenizer=tok)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan
    assert {r.k: r.ids for r in got.collect()} == {1: [257, 258], 2: [], 3: [], 4: [120, 258, 10]}
    twice = df.unionByName(df.where("k = 1")).unionByName(spark.createDataFrame([(None, "ab"), (None, "abc x")], df.schema))
    got = encode(twice, "text", None, ["k"], tokenizer=tok)
    want = {1: [257, 257, 258, 258], 2: [], 3: [], 4: [120, 258, 10], None: [256, 257, 32, 120]}
    assert {r.k: r.ids for r in got.collect()} == want and got.count() == len(want)
    assert dict(got.dtypes) == {"k": "bigint", "ids": "array<int>"}
