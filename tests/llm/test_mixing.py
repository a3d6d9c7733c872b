from cadenza.llm import mixing

SCHEMA = "doc_id long, text string, source string, size string, target string"


def levels(sizes, weights=(1, 2, 3), cap=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        left = total - sum(cap * sizes[s] for s in full)
        rest = sum(w[s] for s in names if s not in full)
        target = {s: cap * sizes[s] if s in full else left * w[s] / rest for s in names}
        over = {s for s in names if s not in full and target[s] > cap * sizes[s]}
        if not over:
            return target
        full |= over


def docs(spark, n=400):
    rows = [(i, "w " * (1 + i % 17), ["hot", "b", "Z", "é", None, "tiny"][min(5, i % 10 if i % 10 > 4 else 0) or i % 5], "x", "y") for i in range(n)]
    rows += [(n, None, "hot", None, None), (n + 1, "", "b", "", ""), (None, "a b c", "tiny", "", ""), (n + 2, "long " * 50_000, "b", "", "")]
    return spark.createDataFrame(rows + rows[:2], SCHEMA)


def test_targets_copies_and_reruns(spark):
    df = docs(spark)
    plan = mixing.mixing_plan(df).collect()
    sizes = {}
    for r in df.collect():
        sizes[r.source] = sizes.get(r.source, 0) + len((r.text or "").split())
    want = levels(sizes)
    assert len(plan) == df.count()
    for r in plan:
        assert abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
        rate = r.target / r.source_size
        assert r.copies in (int(rate), int(rate) + 1) and r.taken == r.copies * r.size and r.copies <= 3
    assert sorted(plan, key=str) == sorted(mixing.mixing_plan(df.repartition(3)).collect(), key=str)
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns
    assert mixed.count() == sum(r.copies for r in plan)


def test_expected_words_are_near_the_target(spark):
    rows = [(i, "a b c d", f"s{i % 5}", None, None) for i in range(5000)]
    plan = mixing.mixing_plan(spark.createDataFrame(rows, SCHEMA)).collect()
    for s in range(5):
        mine = [r for r in plan if r.source == f"s{s}"]
        assert abs(sum(r.taken for r in mine) / mine[0].target - 1) < 0.1


def test_empty_tables(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).count() == 0
    only = spark.createDataFrame([(1, None, None, None, None)], SCHEMA)
    assert [(r.target, r.taken) for r in mixing.mixing_plan(only).collect()] == [(0.0, 0)]
