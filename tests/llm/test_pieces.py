import numpy as np
import pyarrow as pa
import pytest

from almanac.llm import pieces
from almanac.llm.catalog import VOCABULARY
from almanac.llm.words import text_blocks
from tests.llm import cases

TEXTS = [t or "" for t in cases.texts()] + [
    "  hello  world\n\tx ﬁ ①", "don't // a.b\r\n  e\u0301 12 345  99", "a" * 300 + " " * 40 + "日本語テキスト", "<s></s><0x41> <unk>", "x" * 1000 + "the",
]


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.read_vocabulary(VOCABULARY)


def encoded(coder, texts):
    out = []
    for at, to, data, offsets in text_blocks(pa.array(texts)):
        ids, bounds = coder.encode_block(data, offsets, np.arange(at, to).astype(np.uint64))
        out += [ids[bounds[i] : bounds[i + 1]].tolist() for i in range(to - at)]
    return out


def test_without_dropout_ids_equal_the_library(vocabulary):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_proto=vocabulary)
    plain = [t for t in TEXTS if pieces.SPACE not in t and "\x00" not in t]
    assert encoded(pieces.load_coder(vocabulary), plain) == [library.encode(t) for t in plain]


def test_matrix_and_heap_agendas_agree_under_dropout(vocabulary):
    coder = pieces.load_coder(vocabulary, 5, 0.3)
    texts = [w for t in TEXTS for w in t.split(" ")[:40] if 2 <= len(w) <= 60 and pieces.SPACE not in w]
    owns = np.arange(len(texts), dtype=np.uint64) * np.uint64(7919)
    coder._learn([t.encode() for t in texts], owns, np.arange(len(texts), dtype=np.uint64))
    for i, text in enumerate(texts):
        n = coder.numbers[i]
        assert coder.flat[coder.bounds[n] : coder.bounds[n + 1]].tolist() == coder.agenda(text, int(owns[i]))


def test_dropout_varies_decodes_and_repeats(vocabulary):
    a, b = (encoded(pieces.load_coder(vocabulary, seed, 0.2), TEXTS) for seed in (1, 2))
    again = pieces.load_coder(vocabulary, 1, 0.2)
    backwards = encoded(again, TEXTS[::-1][:3])
    assert len(backwards) == 3 and a != b
    assert encoded(again, TEXTS) == a
    for ids, text in zip(a, TEXTS):
        assert again.decode(ids) == text.encode()
    same_word = encoded(again, [" ".join(["straightforward"] * 200)])[0]
    assert len(same_word) > len(encoded(pieces.load_coder(vocabulary), [" ".join(["straightforward"] * 200)])[0])


def test_every_occurrence_is_drawn_by_itself(vocabulary):
    coder = pieces.load_coder(vocabulary, 3, 0.1)
    word = "a" if coder.prefix else "of"  # one candidate
    split = np.mean([len(ids) > 1 for ids in encoded(coder, [word] * 4000)])
    assert 0.08 < split < 0.12
    word = " straightforward"
    many = encoded(coder, ["x" + word] * 1000)
    assert len({tuple(ids) for ids in many}) > 20
    text = "x" + word * 30 + " " + "日本語" * 20 + " the end of it" * 9
    spelled = (" " if coder.prefix else "") + text
    data = np.frombuffer(spelled.encode(), dtype=np.uint8)
    cuts = [0, *pieces._cuts(data, coder.fine).tolist(), len(data)]
    base = pieces.mix(np.array([7], np.uint64) ^ coder.seed)
    want = []
    for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
        own = pieces.mix(base + np.uint64(n))[0]
        want += coder.agenda(data[a:b].tobytes().decode(), int(own))
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    got, _ = coder.encode_block(raw, np.array([0, len(raw)]), np.array([7], np.uint64))
    assert got.tolist() == want


def test_table_round_trip(spark, vocabulary):
    docs = cases.documents(spark)
    out = pieces.encode(docs, vocabulary, 3, 0.1)
    assert out.columns == ["doc_id", "n_tokens", "ids", "lossless"]
    assert out.where("NOT lossless OR n_tokens != size(ids)").isEmpty()
    got = sorted(((r.doc_id, r.text) for r in pieces.decode(out, vocabulary).collect()), key=repr)
    assert got == sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=repr)
    assert pieces.encode(cases.empty(spark), vocabulary).count() == 0
