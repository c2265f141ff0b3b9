import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from llm_rows import SF, corpus, make_docs  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quarry.llm import packing
from quarry.llm.queries import tokenizer_path

PLAIN = Tokenizer.from_file(tokenizer_path())


def ids_of(text):
    return [*PLAIN.encode(text or "", add_special_tokens=False).ids, 1]


def check(rows, texts):
    """Every id in one piece, gapless sequences, no padding; returns the number of sequences."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for doc_id, own in texts.items():
        ids = [ids_of(t) for t in own]
        at = defaultdict(int)
        for r in sorted(pieces[doc_id], key=lambda r: (r.doc_tokens, r.start)):
            match = [x for x in ids if len(x) == r.doc_tokens
                     and zlib.crc32(np.array(x[r.start:r.start + r.length], "<u4").tobytes()) == r.ids_crc32]
            assert match
            at[r.doc_tokens] += r.length
        assert sum(at.values()) == sum(map(len, ids))
    for own in sequences.values():
        total = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == total
            total += r.length
        assert total <= 2048 and total & (total - 1) == 0 and all(r.tier == total for r in own)
    return len(sequences)


def test_documents_round_trip(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id % 5 = 0")
    texts = {r.doc_id: [r.text] for r in df.collect()}
    rows = packing.pack_documents(df.repartition(4), tokenizer_path()).collect()
    tokens = sum(len(ids_of(t)) for [t] in texts.values())
    assert check(rows, texts) <= tokens / 2048 * 1.1 + 4 * 12
    assert sum(r.length for r in rows if r.tier >= 256) > 0.95 * tokens
    steps = defaultdict(int)
    for r in rows:
        steps[r.step_group] += r.length
    assert max(steps.values()) <= packing.STEP_TOKENS + 2048


def test_edge_rows(spark, corpus):
    texts = defaultdict(list)
    for i, t, *_ in corpus:
        texts[i].append(t)
    check(packing.pack_documents(make_docs(spark, corpus), tokenizer_path(), chunk_tokens=3000).collect(), texts)
    assert packing.pack_documents(make_docs(spark, []), tokenizer_path()).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 6000), max_size=60))
def test_pack_covers_each_token_once(lengths):
    seen = defaultdict(int)
    for sequence in packing.pack(lengths):
        total = sum(n for *_, n in sequence)
        assert total <= 2048 and total & (total - 1) == 0
        for d, start, n in sequence:
            seen[d] += n
            assert 0 <= start and start + n <= lengths[d]
    assert [seen[d] for d in range(len(lengths))] == lengths


_characters = st.one_of(st.characters(codec="utf-8"), st.characters(min_codepoint=0xA0, max_codepoint=0x250),
                        st.sampled_from("aeés.,'’ \t\n\x0b\x1c\x85\xa0\u3000\u0301<|>0İßÉ×÷"))


@settings(max_examples=1000, deadline=None)
@given(st.lists(st.text(_characters, max_size=60), max_size=4))
def test_text_ids_equal_the_tokenizer(texts):
    texts = [x for t in texts for x in (t, f"<|endoftext|>{t} it's word. {t}, <|STARTOFTEXT|>", None)]
    got = packing.text_ids(tokenizer_path()).batch(pa.array(texts, pa.string()))
    assert [g.tolist() for g in got] == [PLAIN.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_forgotten_pieces_are_encoded_again(monkeypatch):
    monkeypatch.setattr(packing, "RECENT", 20)
    monkeypatch.setattr(packing, "MEMO_PIECES", 60)
    ids, rng = packing.TextIds(tokenizer_path()), random.Random(0)
    for _ in range(60):
        texts = [" ".join("".join(rng.choices("abcdé'.1", k=rng.randrange(1, 4))) for _ in range(30)) for _ in range(3)]
        assert [g.tolist() for g in ids.batch(pa.array(texts))] == [PLAIN.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(ids.pieces.tables[0]["hash"]) <= 200


def test_a_tokenizer_that_cuts_otherwise_encodes_whole_texts():
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    ids, plain = packing.TextIds(path), Tokenizer.from_file(path)
    texts = ["It's a test, Éric 12.", None, ""]
    assert not ids.cuts
    assert [g.tolist() for g in ids.batch(pa.array(texts, pa.string()))] == [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
