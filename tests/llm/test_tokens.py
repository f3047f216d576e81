import random
import zlib

import numpy as np
from tokenizers import Tokenizer

from jobweave.llm import dac
from jobweave.llm.common import shared_folder
from jobweave.llm.queries import tokenizer_path
from jobweave.llm.tokens import Encoder

HARD = [
    "", "a  b", "a   b c", "x . y", "it's, he'll. a", "\n\n x\n y ", "<|endoftext|>hi", "a\tb", "é, Ü.x ×3 ÷", "...a,.b", "mañana 123,456.7 'tis 's",
    "日本語 text x", "a\0b", "end\n", "end \n", "\n a", "$$$. ok,!!", "x_.y", "a\r\nb", "'S 'RE", " ", " .", "ª.º,", "👍🏽 ok.",
]


def test_pieces_are_the_tokenizers_own():
    path = tokenizer_path()
    plain, own = Tokenizer.from_file(path), Encoder(path)
    rng = random.Random(1)
    alphabet = "ab é.,\n \n'$1_ s t"
    texts = HARD + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    for text, ids in zip(texts, own.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


def test_codes_give_every_id():
    rng = random.Random(2)
    for n in (0, 1, 511, 512, 513, 3000):
        ids = np.array([rng.choice([0, 5, 255, 256, 70_000, 2**31, 2**32 - 1]) for _ in range(n)], dtype="<u4")
        codes = dac.Codes(dac.pack(ids))
        assert len(codes) == n and [codes.get(i) for i in range(n)] == ids.tolist()
        for _ in range(60):
            a, b = sorted((rng.randint(0, n), rng.randint(0, n)))
            assert (codes.slice(a, b) == ids[a:b]).all()


def test_file_round_trip(llm):
    rows = [(i, HARD[i % len(HARD)] * (i % 5), "clash", 1) for i in range(200)]
    rows += [(7, "again", "c", 1), (7, "again", "c", 1), (None, None, "c", 1), (-3, "first " * 30_000, "c", 1)]
    docs = llm.createDataFrame(rows, "doc_id long, text string, start string, shard int").repartition(5)
    path = shared_folder(llm, "tokens-test")
    dac.write_tokens(docs, path, tokenizer_path(), segment_ids=300)
    got = {(r["doc_id"], r["start"]): (r["n_tokens"], r["ids_crc32"]) for r in dac.read_documents(llm, path).collect()}
    plain, start, want, every = Tokenizer.from_file(tokenizer_path()), 0, {}, []
    for doc_id, text, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 0]
        want[(doc_id, start)] = (len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        start += len(ids)
        every += ids
    assert got.keys() - {k for k in got if k[0] == 7} == want.keys() - {k for k in want if k[0] == 7}
    assert sorted(got.values()) == sorted(want.values())
    at = len(every) // 2
    assert dac.read_ids(llm, path, 50, 90) == every[50:90] and dac.read_ids(llm, path, at, at + 5) == every[at : at + 5]


def test_empty_table(llm):
    path = shared_folder(llm, "tokens-none")
    dac.write_tokens(llm.createDataFrame([], "doc_id long, text string"), path, tokenizer_path())
    assert dac.read_documents(llm, path).count() == 0
