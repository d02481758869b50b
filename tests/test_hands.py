import itertools
from collections import Counter

from tablelearn.operators import hands
from tablelearn.sources.text import parse_hand_lines


def _score(spark, lines):
    df = spark.createDataFrame([(i, l) for i, l in enumerate(lines)], "hand_id long, value string")
    return hands.score_hands(parse_hand_lines(df, keep_cols=["hand_id"])).orderBy("hand_id").collect()


def test_golden_hand(spark):  # B1
    r = _score(spark, ["1,13,2,6,1,6,2,11,3,5,1"])[0]
    assert r["rank_points"] == 29 and r["class_score"] == 2000.0 and r["flush_bonus_compat"] == 0
    assert r["total_score_compat"] == 2128.0
    assert r["total_score"] == 2124.0


def test_lowest_pair(spark):  # B2
    r = _score(spark, ["1,2,2,2,1,5,2,9,3,12,0"])[0]
    assert r["longest_run_compat"] is None and r["longest_run"] == 1


def test_four_and_five_suits(spark):  # B3, B4
    four, five = _score(spark, ["1,2,1,4,1,6,1,8,2,10,0", "1,2,1,4,1,6,1,8,1,10,0"])
    assert four["flush_bonus"] == 25 and four["flush_bonus_compat"] == 0
    assert five["flush_bonus"] == 0 and five["flush_bonus_compat"] == 0


def _compat_run(ranks):
    """The documented rule: null when the lowest rank occurs twice; otherwise
    the best island of consecutive ranks, where an island counts 1 for its
    first rank and every later rank as often as it occurs."""
    times = Counter(ranks)
    if times[min(ranks)] > 1:
        return None
    islands = [[r] for r in sorted(times) if r - 1 not in times]
    for island in islands:
        while island[-1] + 1 in times:
            island.append(island[-1] + 1)
    return max(1 + sum(times[r] for r in island[1:]) for island in islands)


def _distinct_run(ranks):
    d = sorted(set(ranks))
    best = cur = 0
    for j, r in enumerate(d):
        cur = cur + 1 if j and r - 1 == d[j - 1] else 1
        best = max(best, cur)
    return best


def test_runs_against_brute_force_all_multisets(spark):
    multisets = list(itertools.combinations_with_replacement(range(1, 14), 5))
    assert len(multisets) == 6188
    rows = [(i, *m) for i, m in enumerate(multisets)]
    df = spark.createDataFrame(rows, "hand_id long, r1 int, r2 int, r3 int, r4 int, r5 int")
    got = df.select("hand_id", hands.hand_longest_run().alias("d"),
                    hands.hand_longest_run(compat=True).alias("c")).collect()
    got = {r["hand_id"]: (r["d"], r["c"]) for r in got}
    throws = 0
    for i, m in enumerate(multisets):
        ref = _compat_run(m)
        throws += ref is None
        assert got[i] == (_distinct_run(m), ref), m
    assert throws == 1820


def test_bad_hand_lines_dropped(spark):
    df = spark.createDataFrame([(0, "1,2,3"), (1, "1,2,1,3,1,4,1,5,1,x,1"), (2, "1,2,1,3,1,4,1,5,1,6,1,99")],
                               "hand_id long, value string")
    out = parse_hand_lines(df, keep_cols=["hand_id"]).collect()
    assert [r["hand_id"] for r in out] == [2]
    flagged = parse_hand_lines(df, keep_cols=["hand_id"], keep_rejects=True).collect()
    assert sum(r["rejected"] for r in flagged) == 2
