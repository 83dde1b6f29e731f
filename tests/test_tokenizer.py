"""A tokenizer with offsets plugged into chunks, prompt windows and id windows."""

import pytest
from pyspark.sql import functions as F

from tessera.functions import tokenizer as K
from tessera.operators import assemble as A
from tessera.operators import segment as S

TEXTS = ["", "word", "int main(void)\n{\n\treturn näive + 日本語; // \U0001F600 ok\n}\n", "a " * 500, None, "   \n", "x" * 3000]


def factories():
    """Made here, so that they travel to workers by value."""
    def letters():  # two characters a token, white space none
        def encode(texts):
            out = []
            for t in texts:
                at = [i for i in range(0, len(t), 2) if not t[i:i + 2].isspace()]
                out.append(([ord(t[i]) for i in at], at, [min(i + 2, len(t)) for i in at]))
            return out
        return encode

    def bpe():
        import public_tokenizers
        from tokenizers import Tokenizer
        own = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))

        def encode(texts):
            got = [own.encode(t, add_special_tokens=False) for t in texts]
            return [(e.ids, [a for a, _ in e.offsets], [b for _, b in e.offsets]) for e in got]
        return encode
    return {"letters": letters, "bpe": bpe}


@pytest.fixture(scope="module", params=["letters", "bpe"])
def factory(request):
    if request.param == "bpe":
        pytest.importorskip("tokenizers")
        pytest.importorskip("public_tokenizers")
    return factories()[request.param]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "i int, text string").repartition(3)


def test_spans_are_the_encoders(df, factory):
    want = {i: list(zip(*e)) for i, e in enumerate(factory()([t or "" for t in TEXTS]))}
    got = {r["i"]: [tuple(x) for x in r["s"]] for r in df.select("i", K.spans(F.col("text"), factory).alias("s")).collect()}
    assert got == want


def test_chunks_are_substrings(df, factory):
    encoded = factory()([t or "" for t in TEXTS])
    rows = S.chunk_tokens(df, size=16, stride=12, tokenizer=factory).collect()
    seen = {}
    for r in rows:
        ids, starts, ends = encoded[r["i"]]
        assert r["chunk_text"] == TEXTS[r["i"]][starts[r["token_start"]]:ends[r["token_end"] - 1]]
        assert 0 < r["token_end"] - r["token_start"] <= 16 and r["token_start"] == 12 * r["chunk_idx"]
        seen.setdefault(r["i"], set()).update(range(r["token_start"], r["token_end"]))
    assert seen == {i: set(range(len(e[0]))) for i, e in enumerate(encoded) if e[0]}


def test_prompt_windows_are_the_text(df, factory):
    w = df.withColumn("s", K.spans(F.col("text"), factory)).select("i", F.size("s").alias("n"), K.windows("text", "s", 16).alias("w")).collect()
    for r in w:
        assert "".join(r["w"]) == (TEXTS[r["i"]] or "") and len(r["w"]) == max(1, -(-r["n"] // 16))


def test_id_windows_hold_every_id(df, factory):
    encoded = factory()([t or "" for t in TEXTS])
    rows = (df.withColumn("s", K.spans(F.col("text"), factory)).withColumn("ids", K.ids("s"))
            .select("i", F.explode(A.tokenize_windows(F.col("ids"), 64)).alias("w")).select("i", "w.*").collect())
    got = {}
    for r in sorted(rows, key=lambda r: (r["i"], r["window"])):
        got.setdefault(r["i"], []).extend(x for x, m in zip(r["input_ids"], r["attention_mask"]) if m)
    assert got == {i: list(e[0]) for i, e in enumerate(encoded)}


def test_lengths_that_differ_are_an_error(df):
    def broken():
        return lambda texts: [([1], [], [])] * len(texts)
    with pytest.raises(Exception, match="as many starts and ends"):
        df.select(K.spans(F.col("text"), broken)).collect()
