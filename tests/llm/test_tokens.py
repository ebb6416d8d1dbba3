"""Problem 8 against the tokenizer's own library, and back."""

import os

import pytest
from pyspark.sql import functions as F

from turnloom.llm.tokens import TOKENIZERS, decoded, token_ids

TEXTS = [None, "", " ", "Hello world", "  two  spaces\n\n\tand tabs ", "I'll don't WE'RE", "Xin chào các bạn, tôi là…", "日本語のテキスト", "<|endoftext|> plain", "🙂👨‍👩‍👧", "a" * 700, "123456 7.5%", "nbsp and　wide", "wwuakw d; zzljw", "é́", "Hello world"]


@pytest.mark.skipif(not os.path.isdir(TOKENIZERS), reason="no tokenizers")
def test_ids(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(f"{TOKENIZERS}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    df = spark.createDataFrame([(i, x) for i, x in enumerate(TEXTS)], "doc_id bigint, text string").withColumn("_w", F.lit("clash"))
    out = token_ids(df)
    got = {r.doc_id: r.ids for r in out.collect()}
    assert got == {i: (t.encode(x, add_special_tokens=False).ids if x else []) for i, x in enumerate(TEXTS)}
    back = {r[0]: r[1] for r in out.select("doc_id", decoded(F.col("ids"))).collect()}
    assert back == {i: x or "" for i, x in enumerate(TEXTS)}
    assert token_ids(df.limit(0)).count() == 0
