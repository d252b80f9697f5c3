import numpy as np
import pyarrow as pa

from almanac.llm import linededup
from almanac.llm.words import text_blocks
from tests.llm import cases

BLANK = " \t\n\x0b\x0c\r"


def key(line):
    found = cases.fold(line.strip(BLANK))
    return found if len(found) >= 10 else None


def brute(rows):
    first, holders = {}, {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if doc is not None and key(line):
                holders.setdefault(key(line), set()).add(doc)
    first = {k: min(v) for k, v in holders.items() if len(v) > 1}
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc is None or key(x) not in first or first[key(x)] == doc]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in df.collect()), key=repr)


def pairs(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_kept_lines_equal_brute_force(spark):
    docs = cases.documents(spark)
    out = linededup.dedup_lines(docs)
    assert found(out) == brute(pairs(docs))
    assert set(docs.columns) < set(out.columns)


def test_an_empty_table_has_no_rows(spark):
    assert linededup.dedup_lines(cases.empty(spark)).count() == 0


def test_line_keys_of_a_block():
    lines = ["", "\n", "a\n\nb  hello world abc \n", " x", "Éé" * 6 + "\n" + "é" * 9, "tail newline is long\n", "", " \t ABCDEFGHIJ\x0b\n"]
    for _, _, data, offsets in text_blocks(pa.array(lines)):
        text, place, k1, k2 = linededup.find_keys(data, offsets)
    want = [(i, j) for i, x in enumerate(lines) for j, line in enumerate(x.split("\n")) if key(line)]
    assert list(zip(text.tolist(), place.tolist())) == want
    assert len(set(k1.tolist())) == len(want) == len(set(k2.tolist()))


def test_insert_in_steps_and_delete(spark):
    docs = cases.documents(spark).where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    index = linededup.LineIndex(spark)
    index.insert(docs.where("doc_id % 3 = 0"))
    index.insert(docs.where("doc_id % 3 = 1"))
    index.insert(docs.where("doc_id % 3 = 2"))
    assert found(linededup.kept_lines(docs, index)) == brute(pairs(docs))
    # Deleting the first holders gives their lines back to the next.
    index.delete(docs.where("doc_id IN (0, 11)"))
    left = docs.where("doc_id NOT IN (0, 11)")
    assert found(linededup.kept_lines(left, index)) == brute(pairs(left))
    index.insert(docs.where("doc_id IN (0, 11)"))
    assert found(linededup.kept_lines(docs, index)) == brute(pairs(docs))


def test_filters_hold_what_the_counts_hold(spark):
    docs = cases.documents(spark)
    index = linededup.LineIndex(spark)
    index.insert(docs)
    again = index.counts.where("first < last")
    assert index._probed(index.counts, "live").count() == index.counts.count()
    assert index._probed(again, "again").count() == again.count() > 0


def test_without_sent_filters_the_result_is_the_same(spark, monkeypatch):
    monkeypatch.setattr(linededup, "PROBED_FILTER_BYTES", 0)
    monkeypatch.setattr(linededup, "SENT_PLACES", 0)
    docs = cases.documents(spark)
    assert found(linededup.dedup_lines(docs)) == brute(pairs(docs))


def test_cuckoo_filter_inserts_finds_and_deletes():
    keys = np.random.default_rng(1).integers(0, 2**63, 20_000, dtype=np.uint64)
    made = linededup.build_filter(keys)
    assert made.contains(keys).all()
    assert made.contains(keys + np.uint64(12345)).mean() < 0.01
    made.delete(keys[:5_000])
    assert made.contains(keys[5_000:]).all()
    assert made.contains(keys[:5_000]).mean() < 0.01
    same = linededup.CuckooFilter.from_bytes(made.to_bytes())
    assert (same.table == made.table).all()
