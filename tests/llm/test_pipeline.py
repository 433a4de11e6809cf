"""The pipeline against brute force, stage by stage."""

from collections import Counter

import corpus_pipeline as C
from corpusgrams.llm import nbsvm, pii
from corpusgrams.llm.common import labels, saved_table

from .test_dedup import exact_brute, near_brute


def test_stages_match_brute_force(spark, sf, docs, marks):
    assert [n for n, _ in C.STAGES] == ["quality", "exact_dedup", "near_dedup", "pii", "packing"]
    now, rows = docs, {}
    for name, stage in C.STAGES:
        before = [(r.doc_id, r.text) for r in now.collect()] if name != "packing" else None
        out = saved_table(stage(spark, now, sf))
        if name != "packing":
            assert out.schema == docs.schema
        rows = [tuple(r) for r in out.collect()]
        ids = sorted(r[0] for r in rows)
        if name == "quality":
            scores = nbsvm.quality_scores(docs, nbsvm.fit(docs, marks)).filter("predicted = 1").collect()
            assert ids == sorted(r.doc_id for r in scores)
        elif name == "exact_dedup":
            assert ids == sorted({keep for _, keep, _, _ in exact_brute(before)[0]})
        elif name == "near_dedup":
            assert ids == sorted({c for (_, c, _) in near_brute(before)[0]})
        elif name == "pii":
            assert ids == sorted(i for i, _ in before)
            dirty = {r.doc_id for r in pii.find_personal_data(now).filter("size(spans) > 0").collect()}
            texts = dict(before)
            assert {r[0] for r in rows if r[1] != texts[r[0]]} == dirty
        else:
            assert {r[0] for r in rows} == set(packed_from)
        packed_from = ids
        now = out


def test_run_gives_the_last_stage(spark, sf):
    assert C.run(spark, sf).columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def test_edge_rows_pass_every_stage(spark, sf, edge, nothing, tmp_path):
    """Each stage keeps of the edge rows exactly what it keeps by brute force."""
    for df in (edge, nothing):
        now, before = df, []
        for name, stage in C.STAGES:
            now = saved_table(stage(spark, now, sf))
            if name == "quality":
                good = nbsvm.quality_scores(df, nbsvm.fit(df, labels(spark, sf))).filter("predicted = 1").count()
                assert now.count() == good
            elif name == "exact_dedup":
                assert now.count() == exact_brute(before)[1]
            elif name == "near_dedup":
                assert now.count() == near_brute(before)[1]
            elif name == "pii":
                assert Counter(r.doc_id for r in now.collect()) == Counter(i for i, _ in before)
            else:
                assert {r.doc_id for r in now.collect()} == {i for i, _ in before}
            if name != "packing":
                assert now.columns == df.columns
                before = [(r.doc_id, r.text) for r in now.collect()]
        assert df.count() > 0 or now.count() == 0


def test_every_dealt_operator_is_registered():
    import __spark_entry__ as E

    names = E.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert "pipeline" in names
