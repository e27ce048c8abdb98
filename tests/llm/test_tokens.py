import random

import duckdb
import pytest

from fleetspan.llm.tokens import ChunkEncoder, encoding, safe_places, token_counts, token_ids, token_path

AL = "ab '  \n\t\r1²٣éÉ日本ไทย้ं​﻿\xa0 .,!?'sdtremvl\U0001f600…́<|endoftext|>"


@pytest.fixture(scope="module")
def whole():
    return encoding(token_path()).encode_ordinary


def split(ids, count):
    out, at = [], 0
    for n in count:
        out.append(ids[at : at + n].tolist())
        at += n
    return out


@pytest.mark.parametrize("bits", [1, 2, 4, 7])
def test_chunks_give_the_ids_of_the_whole_text(whole, bits):
    r = random.Random(bits)
    words = ["".join(r.choice(AL) for _ in range(r.randrange(1, 30))) for _ in range(40)]
    texts = ["".join(r.choice(words) for _ in range(r.randrange(0, 30))) for _ in range(800)]
    texts += ["", " ", "a" * 20_000, "\n" * 5_000, "日" * 3_000, "1" * 5_000, "<|endoftext|>", "'s" * 2_000, "ab " * 30_000]
    assert split(*ChunkEncoder(token_path(), bits).encode_batch(texts)) == [whole(t) for t in texts]


def test_documents(whole):
    texts = [t or "" for (t,) in duckdb.sql("select text from '/root/testdata/sf0.01/documents.parquet'").fetchall()]
    e = ChunkEncoder(token_path())
    assert split(*e.encode_batch(texts)) == [whole(t) for t in texts]
    assert e.encoded < e.used  # chunks were reused


def test_the_other_library_agrees():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(token_path().replace(".tiktoken", ".json"))
    t.encode_special_tokens = True
    texts = ["Olá, <|endoftext|> mundo!  Isn't it?\n\nà toa 日本語 12.5", "", "   "]
    assert split(*ChunkEncoder(token_path(), 2).encode_batch(texts)) == [x.ids for x in t.encode_batch(texts, add_special_tokens=False)]


def test_no_safe_place_is_inside_a_piece(whole):
    import numpy as np

    from fleetspan.llm.tokens import char_classes

    r = random.Random(9)
    for _ in range(300):
        t = "".join(r.choice(AL) for _ in range(60))
        cp = np.frombuffer(t.encode("utf-32-le"), dtype=np.uint32)
        for i in np.flatnonzero(safe_places(cp, char_classes()[cp])):
            assert whole(t) == whole(t[:i]) + whole(t[i:])


def test_nulls_empty_and_clashing_columns(spark, whole):
    rows = [(1, None), (2, ""), (3, "a b"), (None, "x"), (3, "a b"), (4, "long " * 50_000)]
    df = spark.createDataFrame([(*r, "i", "s") for r in rows], "doc_id bigint, text string, ids string, source string")
    got = sorted(((r["doc_id"] or 0, list(r["ids"])) for r in token_ids(df).collect()), key=str)
    assert got == sorted(((k or 0, whole(t or "")) for k, t in rows), key=str)
    assert sorted(r["tokens"] for r in token_counts(df, also=("source",)).collect()) == sorted(len(whole(t or "")) for _, t in rows)
    assert token_ids(df.limit(0)).count() == 0
