import random
import re
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from llm_fixtures import as_docs, docs  # noqa: F401
from mercato.llm.byte_bpe import WordEncoder
from mercato.llm.common import tokenizer_path
from mercato.llm.queries import op5_token_files
from mercato.llm.token_files import (pack_bits, pack_segment, read_ids, read_segment, read_tokens, unpack_bits,
                                     width_of, write_and_read, write_tokens)

SF = "/root/testdata/sf0.001"
PATH = tokenizer_path("byte_bpe_50k.json")


@pytest.mark.parametrize("width", [1, 7, 8, 11, 15, 16, 17, 31, 32])
def test_bits_round_trip_and_random_access(width):
    ids = np.random.default_rng(width).integers(0, 1 << width, 10_001, dtype=np.uint64).astype(np.uint32)
    packed = pack_bits(ids, width)
    assert len(packed) == -(-len(ids) * width // 8)
    assert (unpack_bits(packed, len(ids), width) == ids).all()
    segment = pack_segment(ids, width, block_ids=64)
    for a, b in [(0, None), (5, 6), (63, 65), (640, 10_001), (9_999, 20_000), (4, 4)]:
        assert (read_segment(segment, a, b) == ids[a:b]).all()


def test_ids_beyond_the_width_and_empty_segments():
    assert width_of(50_257) == 16 and width_of(1) == 1 and width_of(65_537) == 17
    with pytest.raises(ValueError):
        pack_segment(np.array([70_000], np.uint32), 16)
    assert len(read_segment(pack_segment(np.zeros(0, np.uint32), 16))) == 0


def test_word_cut_equals_the_library():
    tokenizer, rng = Tokenizer.from_file(PATH), random.Random(5)
    texts = ["", "'", " '", "it's 'm'm I'LL we'REre've", " \n  x \n", "　x\xa0 z", "3a4b ½ ٣", "<|endoftext|> hi",
             "日本語 漢字", "😀🦤", "a\x85b\x1cc\x00d", "\n \n", "a\n\nb", "é̂ x​z"]
    texts += ["".join(rng.choice(" '\n\tstmdrevlaXé1.") for _ in range(rng.randint(1, 30))) for _ in range(3000)]
    flat, counts = WordEncoder(PATH).encode(texts)
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert counts.tolist() == [len(w) for w in want]
    assert flat.tolist() == [i for w in want for i in w]


def by_library(rows):
    tokenizer, out, start = Tokenizer.from_file(PATH), [], 0
    for i, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query_equals_the_library(spark, docs):
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    got = op5_token_files(spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == by_library(rows)


def test_nulls_ties_long_texts_and_random_access(spark, as_docs, scratch):
    rows = [(None, "a"), (3, None), (1, ""), (2, "word " * 60_000), (9, "x"), (9, "x"), (9, None)]
    path = write_tokens(as_docs(rows), PATH, scratch("tokens"), segment_ids=100)
    got = sorted(map(tuple, read_tokens(spark, path).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [None, 1, 2, 3, 9, 9, 9]
    assert [r[1] for r in got] == np.cumsum([0] + [r[2] for r in got])[:-1].tolist()
    by_id = {r[0]: r for r in got}
    words = Tokenizer.from_file(PATH).encode("word " * 60_000, add_special_tokens=False).ids
    first = min(r[1] for r in got if r[4] == by_id[2][4])
    ids = read_ids(spark, path, by_id[2][4], by_id[2][1] - first + 30_000, 1000)
    assert ids.tolist() == words[30_000:31_000]
    assert sum(r[2] == 1 for r in got) == 3
    assert re.fullmatch(r"\d+", str(by_id[1][3]))


def test_empty_table(spark, as_docs):
    assert write_and_read(as_docs([(1, "a")]).limit(0), PATH).count() == 0


def test_rolling_hashes_of_a_long_array_leave_no_long_tables():
    from mercato.llm.common import Rolling

    values = np.random.default_rng(0).integers(0, 256, Rolling.KEPT + 1000).astype(np.uint8)
    long, short = Rolling(values), Rolling(values[5000:9000].copy())
    assert (long.of(np.array([5000]), np.array([9000])) == short.of(np.array([0]), np.array([4000]))).all()
    assert (long.windows(64)[5000:8000] == short.windows(64)[:3000]).all()
    assert len(Rolling._powers) <= Rolling.KEPT
