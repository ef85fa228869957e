import random

from loomgraph.llm.mixing import mix_report, mix_sources


def tables(spark, sizes, targets):
    rng = random.Random(4)
    rows = [(f"{s}{i}", s, rng.randrange(1, 400)) for s, n in sizes.items() for i in range(n)]
    rows += [("null", None, 5), ("zero", "a", 0)]
    sized = spark.createDataFrame([(k, s, x, "clash") for k, (_, s, x) in enumerate(rows)], "doc_id bigint, source string, n_tokens bigint, copies string")
    return sized, spark.createDataFrame(targets, "source string, target_share double, max_repeats int")


def test_shares_and_caps(spark):
    sized, targets = tables(spark, {"a": 900, "b": 300, "c": 40, "d": 50}, [("a", 0.5, 2), ("b", 0.3, 1), ("c", 0.2, 4), ("d", 0.0, 3), ("none", 0.0, 1)])
    for parts in (4096, 3):
        mix = mix_sources(sized, targets, rank_parts=parts)
        rows = mix.collect()
        assert len({r.doc_id for r in rows}) == len(rows)
        cap = {"a": 2, "b": 1, "c": 4}
        assert all(1 <= r.copies <= cap[r.source] for r in rows)
        report = {r.source: r for r in mix_report(mix, targets).collect()}
        assert set(report) == {"a", "b", "c", "d", "none"} and report["d"].tokens == 0
        for s in "abc":
            assert abs(report[s].actual_share - report[s].target_share) < 0.005
        assert sorted(map(tuple, rows)) == sorted(map(tuple, mix_sources(sized, targets, rank_parts=parts).collect()))


def test_longer_documents_are_likelier(spark):
    sized, targets = tables(spark, {"a": 3000, "b": 3000}, [("a", 0.5, 1), ("b", 0.5, 1)])
    total = sized.selectExpr("sum(n_tokens)").first()[0]
    rows = mix_sources(sized, targets, total_tokens=total // 4, power=1.0).collect()
    n_all = sized.where("source is not null and n_tokens > 0").selectExpr("avg(n_tokens)").first()[0]
    assert sum(r.n_tokens for r in rows) / len(rows) > 1.15 * n_all
    assert abs(sum(r.n_tokens for r in rows) - total / 4) < 0.02 * total


def test_too_large_a_total_falls_short(spark):
    sized, targets = tables(spark, {"a": 100, "b": 10}, [("a", 0.5, 1), ("b", 0.5, 2)])
    rows = mix_sources(sized, targets, total_tokens=10**7).collect()
    assert {(r.source, r.copies) for r in rows} == {("a", 1), ("b", 2)}


def test_nothing_to_mix(spark):
    sized, targets = tables(spark, {}, [("a", 1.0, 1)])
    assert mix_sources(sized, targets).count() == 0
    assert mix_report(mix_sources(sized, targets), targets).first().actual_share == 0.0
    assert mix_sources(sized, targets.limit(0)).count() == 0
