"""The pipeline stage by stage against the operators' brute-force versions."""

import corpus_pipeline as P

from tests.llm import test_minhash, test_packing, test_quality, test_secrets, test_tiling
from tributary.llm import quality, secrets


def test_stages_equal_brute_force(spark, sf, docs):
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert [n for n, _ in P.STAGES] == ["quality_rules", "near_dedup", "decontamination", "secret_scan", "best_fit_packing"]
    rows = {r.doc_id: r for r in docs.collect()}

    out = P.quality_rules(spark, docs, sf)
    assert out.columns == docs.columns
    kept = {}
    for d, r in rows.items():
        base = test_quality.base(r.text)
        covered, longest = (0, 0) if base[5] else test_quality.repeats(r.text, quality.MIN_REPEAT)
        if not base[5] and 100 * covered <= quality.MAX_COVERED_PERCENT * base[0] \
                and 100 * longest <= quality.MAX_LONGEST_PERCENT * base[0]:
            kept[d] = r
    assert {r.doc_id: r for r in out.collect()} == kept

    out = P.near_dedup(spark, spark.createDataFrame(list(kept.values()), docs.schema), sf)
    assert out.columns == docs.columns
    kept = {d: kept[d] for d, _, _, k in test_minhash.brute([(d, r.text) for d, r in kept.items()], 80) if k}
    assert {r.doc_id: r for r in out.collect()} == kept

    out = P.decontamination(spark, spark.createDataFrame(list(kept.values()), docs.schema), sf)
    assert out.columns == docs.columns
    dirty = set()
    for d, r in kept.items():
        w = test_tiling.words(r.text)
        own = {tuple(w[j:j + 5]) for j in range(len(w) - 4)}
        for i, x in bench:
            v = test_tiling.words(x)
            if own & {tuple(v[j:j + 5]) for j in range(len(v) - 4)} and test_tiling.brute([(d, r.text)], [(i, x)]):
                dirty.add(d)
    kept = {d: r for d, r in kept.items() if d not in dirty}
    assert dirty and {r.doc_id: r for r in out.collect()} == kept

    out = P.secret_scan(spark, spark.createDataFrame(list(kept.values()), docs.schema), sf)
    assert out.columns == docs.columns
    got = {r.doc_id: r for r in out.collect()}
    assert got.keys() == kept.keys()
    for d, r in kept.items():
        found = test_secrets.plain(r.text)
        assert (got[d].text == r.text) == (not secrets.find(r.text)) and got[d].n_chars == len(got[d].text)
        assert not any(found[:3]) or test_secrets.plain(got[d].text)[:3] == (0, 0, 0)

    packed = P.best_fit_packing(spark, out, sf).collect()
    test_packing.check(packed, {d: len(r.text.split()) for d, r in got.items()}, 4096)

    whole = P.run(spark, sf).collect()
    assert sorted((r.doc_id, r.piece, r.n_words) for r in whole) == sorted((r.doc_id, r.piece, r.n_words) for r in packed)


def test_null_and_repeated_rows(spark):
    text = " ".join(f"w{i}" for i in range(80))
    rows = [(1, text, "en", "s", 9), (1, text, "en", "s", 9), (None, text, None, None, None), (2, None, "en", "s", 0),
            (3, "x y " * 100, "en", "s", 1), (None, "token=abcdefgh12 " + " ".join(f"u{i}" for i in range(90)), None, "t", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    bench = "/root/testdata/sf0.001"
    one = P.quality_rules(spark, docs, bench)
    assert sorted(str(r.doc_id) for r in one.collect()) == ["1", "1", "None", "None"]
    two = P.near_dedup(spark, one, bench)
    assert sorted(str(r.doc_id) for r in two.collect()) == ["1", "1", "None", "None"]
    assert P.near_dedup(spark, docs.limit(0), bench).count() == 0
    clash = two.selectExpr("*", "1 as kept_id", "2 as blob", "'x' as spans", "3 as component_id", "4 as bin_id", "5 as place")
    again = P.decontamination(spark, P.near_dedup(spark, P.quality_rules(spark, clash, bench), bench), bench)
    again = P.secret_scan(spark, again, bench)
    assert again.columns == clash.columns and again.count() == 4
    assert P.best_fit_packing(spark, again, bench).count() == 4
    four = P.secret_scan(spark, two, bench).collect()
    assert sum("[SECRET]" in r.text for r in four) == 1
    assert P.best_fit_packing(spark, docs.limit(0), bench).count() == 0
