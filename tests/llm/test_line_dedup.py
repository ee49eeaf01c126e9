"""Against a brute-force pass over all windows in order."""

import random

import pytest

from strata.llm import line_dedup as ld

from llm_fixtures import SCHEMA, nothing, odd, prose, rows_from  # noqa: F401


def brute(rows):
    """rows: (doc_id, text). What is left of each, in the documented order of occurrences."""
    seen, out = set(), {}
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        if text is None:
            out[doc] = (None, 0)
            continue
        lines = text.split("\n")
        solid = [(i, x.strip(" \t\r")) for i, x in enumerate(lines) if x.strip(" \t\r")]
        gone = set()
        for k in range(len(solid) - 2):
            w = tuple(x for _, x in solid[k : k + 3])
            if w in seen:
                gone.update(range(solid[k][0], solid[k + 2][0] + 1))
            seen.add(w)
        for i, x in enumerate(lines):
            if i not in gone and not x.strip(" \t\r"):
                before = next((j for j in range(i - 1, -1, -1) if lines[j].strip(" \t\r")), None)
                after = next((j for j in range(i + 1, len(lines)) if lines[j].strip(" \t\r")), None)
                if before in gone and after in gone:
                    gone.add(i)
        out[doc] = ("\n".join(x for i, x in enumerate(lines) if i not in gone), len(gone))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    pool = [prose(rng, 3) for _ in range(12)] + ["", "  ", "Ä\t"]
    rows = [(k, rng.choice(["\n", "\r\n"]).join(rng.choice(pool) for _ in range(rng.randint(0, 14)))) for k in range(60)]
    rows += [(100, None), (101, "\n".join(["same"] * 50))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.text, r.n_removed) for r in ld.op3_line_dedup(df).collect()}
    assert got == brute(rows)


def test_a_passage_in_very_many_documents_stays_once(spark):
    rng = random.Random(1)
    passage = "\n".join(prose(rng, 20) for _ in range(4))
    rows = [(k, prose(rng, 8) + f" {k}\n" + passage + f"\nend {k}") for k in range(3000)]
    got = {r.doc_id: r.text for r in ld.op3_line_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()}
    assert passage in got[0] and sum(passage in t for t in got.values()) == 1
    assert all(got[k].split("\n") == [rows[k][1].split("\n")[0], f"end {k}"] for k in range(1, 3000))


def test_columns_pass_through_and_odd_rows_are_kept(spark, odd, nothing):
    out = ld.dedup_lines(odd)
    assert out.columns == [*odd.columns, ld.GONE]
    assert sorted(map(repr, out.drop(ld.GONE).collect())) == sorted(map(repr, odd.collect()))
    assert ld.dedup_lines(nothing).count() == 0


def test_rows_that_agree_in_id_and_text_are_one_document(spark):
    text = "one\ntwo\nthree"
    rows = rows_from([text]) * 2 + [(None, text, "en", "s", None), (None, text, "en", "t", None)]
    out = ld.dedup_lines(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((repr(r.doc_id), r.text, r.n_chars) for r in out) == [("0", text, 13)] * 2 + [("None", "", 0)] * 2
