import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tessera.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ["", "Hello, World! it's  10 o'clock", "a<|endoftext|>b <|startoftext|><|endoftext|", "ΟΔΟΣ ΣΑΣ", "İstanbul ǅ ß ﬁ", "naïve é 日本語 ١٢3 \x1c\x85 x",
         "aaaaaaaaaaa " * 3, "don't we'll I'M 'S", "a" * 3000, "\u0000\u00ad\ufeff", "e\u0301 \u0041\u030a", "🎉🎉👩‍👩‍👧"]


def fuzz():
    rng = random.Random(5)
    ranges = [(32, 127), (0xA0, 0x250), (0x391, 0x3A1), (0x4E00, 0x4F00), (0x1F300, 0x1F5FF)]
    return ["".join(chr(rng.randrange(*rng.choice(ranges))) for _ in range(rng.randrange(80))) for _ in range(300)]


def test_ids_and_decoded_texts_equal_the_librarys():
    lib = Tokenizer.from_file(PATH)
    lib.no_truncation()
    lib.no_padding()
    source = open(PATH).read()
    mine, tokens = bpe.Bpe(source), bpe.vocabulary(source)
    texts = TEXTS + fuzz()
    for part in (texts, texts[::-1]):  # the second time words are known
        ids, off = mine.encode(part)
        for text, a, b, want in zip(part, off[:-1], off[1:], lib.encode_batch(part, add_special_tokens=False)):
            assert ids[a:b].tolist() == want.ids, text
            assert bpe.decode_ids(tokens, ids[a:b]) == lib.decode(want.ids, skip_special_tokens=False)


def test_rows_and_other_columns_stay(spark):
    data = [(1, None, "x"), (1, None, "x"), (2, "", None), (3, "word " * 50_000, "y"), (None, "Word", "z")]
    df = spark.createDataFrame(data, "doc_id long, text string, ids string").withColumnRenamed("ids", "decoded")
    out = bpe.decode(bpe.encode(df, PATH), PATH).collect()
    assert len(out) == 5
    by = {(r.doc_id, (r.text or "")[:4]): r for r in out}
    assert by[(1, "")].ids == b"" and by[(1, "")].decoded == "" and by[(2, "")].decoded == ""
    assert len(by[(3, "word")].ids) == 4 * 50_000 and by[(None, "Word")].decoded == "word</w>"
    assert bpe.encode(spark.createDataFrame([], df.schema), PATH).collect() == []


def test_a_tokenizer_of_another_kind_is_refused():
    with pytest.raises((ValueError, TypeError, KeyError)):
        bpe.Bpe(open(public_tokenizers.path("byte_bpe_50k.json")).read())


def test_unknown_ids_are_left_out():
    tokens = bpe.vocabulary(open(PATH).read())
    assert bpe.decode_ids(tokens, np.array([518, 4_000_000], np.uint32)) == "the</w>"
