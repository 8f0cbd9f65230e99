import zlib
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lendframe.llm import packing as P

WHOLE = Tokenizer.from_file(P.tokenizer_path())
ENCODER = P.Encoder(P.tokenizer_path())


def ids_of(text):
    return WHOLE.encode(text or "", add_special_tokens=False).ids + [1]


def check(pieces, texts, capacity):
    by_sequence, covered = defaultdict(list), Counter()
    for p in pieces:
        by_sequence[p.sequence_id].append(p)
        covered[p.doc_id, p.start, p.length, p.doc_tokens, zlib.crc32(p.ids)] += 1
    for group in by_sequence.values():
        at = 0
        for p in sorted(group, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0 and len(p.ids) == 4 * p.length
            at += p.length
        assert at <= capacity
    found = defaultdict(list)
    for p in pieces:
        found[p.doc_id, p.doc_tokens].append((p.start, p.ids))
    want = Counter()
    for doc_id, text in texts:
        want[doc_id, len(ids_of(text))] += 1
    assert set(found) == set(want)
    lookup = {(d, len(ids_of(t))): np.array(ids_of(t), "<u4").tobytes() for d, t in texts}
    for key, parts in found.items():  # every id lies in one piece for each row of the document
        seen = np.zeros(key[1], int)
        for start, ids in parts:
            assert lookup[key][4 * start : 4 * start + len(ids)] == ids
            seen[start : start + len(ids) // 4] += 1
        assert (seen == want[key]).all()
    return by_sequence


def test_round_trip_and_fill(docs):
    pieces = P.pack(docs, P.tokenizer_path()).collect()
    sequences = check(pieces, [(r.doc_id, r.text) for r in docs.collect()], P.CAPACITY)
    tokens = sum(p.length for p in pieces)
    assert len(sequences) == -(-tokens // P.CAPACITY)  # nothing but the last is padded


def test_messy(messy, messy_rows):
    check(P.pack(messy, P.tokenizer_path(), capacity=64, open_windows=3, fan=2).collect(), [r[:2] for r in messy_rows], 64)


def test_empty(empty):
    assert P.pack(empty, P.tokenizer_path()).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("abAB'sStlLéÉßµ.,!?-_12 \n\t\x1c\x85 ́Σς日<|>endofxt")), max_size=40))
def test_words_encode_as_the_whole(text):
    assert np.frombuffer(ENCODER(text), "<u4").tolist() == ids_of(text)[:-1]


def test_lowering_and_memory():
    """Words that differ in case are held once, and lowering before the tokenizer changes no id where a mark or a special token is near."""
    encode = P.Encoder(P.tokenizer_path())
    for text in ("Word WORD word", "H\u0331 h\u0331 I\u0307 E\u0301 \u212a \u1e96", "A <|endoftext|> B <|ENDOFTEXT|>", "Casa, CASA. casa", "DON'T I'LL 'S"):
        assert np.frombuffer(encode(text), "<u4").tolist() == ids_of(text)[:-1]
    fresh = P.Encoder(P.tokenizer_path())
    fresh("Word WORD word")
    assert len(fresh.words) == 1
