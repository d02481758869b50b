"""DuckDB SQL equivalents of the named queries (the correctness oracle).

The SQL is written independently of the Spark plans: entropies use the
textbook form -sum p ln p, deviations are two-pass, the area under ROC uses
a plain running window, hand runs use unnest + gaps-and-islands.  Columns
are aliased and typed like the Spark output; doubles are rounded to the
same number of decimals.
"""

from __future__ import annotations

import re

from tablelearn.operators.mllib import PUBLISHED_TREE
from tablelearn.plans import catalog as C
from tablelearn.sources.text import INJURY_COLUMNS

R = C.DIGITS


def rnd(expr: str, digits: int = R) -> str:
    return f"round(CAST({expr} AS DOUBLE), {digits})"


def bucket_sql(seed: int, keys) -> str:
    parts = ", ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return f"CAST(('0x' || substr(md5(concat_ws(':', '{seed}', {parts})), 1, 8)) AS BIGINT)"


def split_sql(seed: int, keys, weights) -> str:
    total = float(sum(weights))
    acc, bounds = 0.0, []
    for w in weights:
        acc += w
        bounds.append(round(acc / total * 4294967296))
    b = bucket_sql(seed, keys)
    whens = " ".join(f"WHEN {b} < {bound} THEN {i}" for i, bound in enumerate(bounds[:-1]))
    return f"CAST(CASE {whens} ELSE {len(bounds) - 1} END AS INTEGER)"


INJURY_KEY = ", ".join(C.INJURY_KEY)

INJURY = """(SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CAST(trunc(18 + l_quantity % 22) AS INTEGER) AS Player_Age,
    40.0 + l_extendedprice / 1750 AS Player_Weight,
    145.0 + (l_partkey * 7919 + l_suppkey * 104729) % 60000 / 1000 AS Player_Height,
    CAST(l_returnflag = 'R' AS INTEGER) AS Previous_Injuries,
    l_discount * 10 AS Training_Intensity,
    l_linenumber AS Recovery_Time,
    CAST(l_linestatus = 'F' AS INTEGER) AS Likelihood_of_Injury
  FROM lineitem)"""

EVENTS = """(SELECT event_id, value, CAST(hour(ts) AS INTEGER) AS hour, user_id,
    TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
    CAST(event_type = 'purchase' AS INTEGER) AS label
  FROM events)"""

METRICS = f"""(SELECT event_id, CAST(value > 100 AS DOUBLE) AS prediction, value AS score,
    CAST(label AS DOUBLE) AS label FROM {EVENTS})"""


def _hands_sql() -> str:
    cols = ["o_orderkey AS hand_id"]
    for i in range(5):
        step = f"CASE o_orderkey % 5 WHEN 0 THEN 0 WHEN 1 THEN {int(i == 4)} ELSE {i * 5} END"
        cols.append(f"CAST((o_orderkey * 7 + {step}) % 4 + 1 AS INTEGER) AS s{i + 1}")
        cols.append(f"CAST((o_orderkey * {2 * i + 1} + {3 * i * i} + o_orderkey // 13) % 13 + 1 AS INTEGER) AS r{i + 1}")
    cols.append("CAST(o_orderkey % 10 AS INTEGER) AS class")
    return "(SELECT " + ", ".join(cols) + " FROM orders)"


HANDS = _hands_sql()

DOCS = """(SELECT l.doc_id,
    CASE WHEN d.n_chars > 0 THEN ln(CAST(d.n_chars AS DOUBLE)) END AS log_chars,
    CASE WHEN d.n_chars <> 0 THEN CAST(length(d.text) - length(replace(d.text, ' ', '')) + 1 AS DOUBLE)
         / CAST(d.n_chars AS DOUBLE) END AS word_density,
    CASE WHEN d.n_chars <> 0 THEN CAST(length(d.text) - length(regexp_replace(d.text, '[0-9]', '', 'g')) AS DOUBLE)
         / CAST(d.n_chars AS DOUBLE) END AS digit_share,
    d.lang, d.source, l.quality AS label
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""

DOC_SPLIT = f"(SELECT *, {split_sql(C.SEED_90_10, ['doc_id'], [0.9, 0.1])} AS split FROM {DOCS})"


def _key_str(f: str, double: bool) -> str:
    if double:
        return f"CAST(CASE WHEN {f} = 0 THEN CAST(0 AS DOUBLE) ELSE {f} END AS VARCHAR)"
    return f"CAST({f} AS VARCHAR)"


DOUBLE_FEATURES = {"Player_Weight", "Player_Height", "Training_Intensity"}


def gain_ctes(rel: str, features, label: str, keys=(), p: str = "", where: str = "TRUE",
              extra=(), cast_features: bool = True, double_features=None) -> str:
    """CTEs ending in ``{p}g``: per (keys.., feature) n, label_entropy,
    conditional_entropy, feature_entropy, gain, gain_compat, feature_pos."""
    k = "".join(f"{x}, " for x in keys)
    dbl = DOUBLE_FEATURES if double_features is None else set(double_features)
    feats = [f"{_key_str(f, f in dbl)} AS {f}" if cast_features else f for f in features]
    sel = ", ".join([*keys, label, *extra] + feats)
    on = ", ".join(features)
    pos = ", ".join(f"('{f}', {i})" for i, f in enumerate(features))
    return f"""
{p}long AS (SELECT * FROM (UNPIVOT (SELECT {sel} FROM {rel}) ON {on} INTO NAME feature VALUE value) WHERE {where}),
{p}cells AS (SELECT {k}feature, value, {label}, count(*) AS n FROM {p}long GROUP BY ALL),
{p}nf AS (SELECT {k}feature, sum(n) AS nn FROM {p}cells GROUP BY ALL),
{p}nv AS (SELECT {k}feature, value, sum(n) AS nv FROM {p}cells GROUP BY ALL),
{p}nl AS (SELECT {k}feature, {label}, sum(n) AS nl FROM {p}cells GROUP BY ALL),
{p}hy AS (SELECT {k}feature, -sum((nl / nn) * ln(nl / nn)) / ln(2) AS hy FROM {p}nl JOIN {p}nf USING ({k}feature) GROUP BY ALL),
{p}hv AS (SELECT {k}feature, value, -sum((n / nv) * ln(n / nv)) / ln(2) AS hv FROM {p}cells JOIN {p}nv USING ({k}feature, value) GROUP BY ALL),
{p}hyx AS (SELECT {k}feature, sum((nv / nn) * hv) AS hyx FROM {p}hv JOIN {p}nv USING ({k}feature, value) JOIN {p}nf USING ({k}feature) GROUP BY ALL),
{p}hx AS (SELECT {k}feature, -sum((nv / nn) * ln(nv / nn)) AS hx FROM {p}nv JOIN {p}nf USING ({k}feature) GROUP BY ALL),
{p}fp AS (SELECT * FROM (VALUES {pos}) AS t(feature, feature_pos)),
{p}g AS (SELECT {k}feature, CAST(nn AS BIGINT) AS n, greatest(hy, 0) AS label_entropy, greatest(hyx, 0) AS conditional_entropy,
        greatest(hx, 0) AS feature_entropy, greatest(hy, 0) - greatest(hyx, 0) AS gain,
        greatest(hy, 0) - greatest(hx, 0) AS gain_compat, CAST(feature_pos AS INTEGER) AS feature_pos
      FROM {p}hy JOIN {p}hyx USING ({k}feature) JOIN {p}hx USING ({k}feature) JOIN {p}nf USING ({k}feature) JOIN {p}fp USING (feature))"""


def id3_ctes(train_rel: str, test_rel: str | None, features, label: str, first: str, depth: int, keys=(),
             gain_col: str = "gain", leaf: str = "majority", text_label: bool = False) -> str:
    """Level-by-level ID3 as CTEs: ``nodes`` (all levels) and, with
    ``test_rel``, ``pred`` (keys.., label, prediction).  ``gain_col`` is
    ``gain`` or ``gain_compat``; ``leaf`` is ``majority`` or
    ``mean_first_column``."""
    feats, out = list(features), "VARCHAR" if text_label else "DOUBLE"
    fcols = ", ".join(f"CAST({f} AS VARCHAR) AS {f}" for f in feats)
    ctes = [f"r0 AS (SELECT {fcols}, {label}, CAST({first} AS DOUBLE) AS first_col, '' AS node, "
            f"CAST([] AS VARCHAR[]) AS used FROM {train_rel})"]
    node_names = []
    for d in range(depth + 1):
        r = f"r{d}"
        ctes.append(f"c{d} AS (SELECT node, {label}, count(*) AS cnt, sum(first_col) AS sf FROM {r} GROUP BY ALL)")
        ctes.append(f"mj{d} AS (SELECT node, {label} AS majority FROM c{d} "
                    f"QUALIFY row_number() OVER (PARTITION BY node ORDER BY cnt DESC, {label}) = 1)")
        ctes.append(f"s{d} AS (SELECT node, CAST(sum(cnt) AS BIGINT) AS n, count(*) AS classes, "
                    f"{'CAST(NULL AS DOUBLE)' if text_label else f'sum({label} * cnt) / sum(cnt)'} AS mean_label, sum(sf) / sum(cnt) AS mean_first_column "
                    f"FROM c{d} GROUP BY node)")
        if d < depth and d < len(feats):
            ctes.append(gain_ctes(r, feats, label, ["node"], p=f"l{d}_", where="NOT list_contains(used, feature)",
                                  extra=["used"], cast_features=False).strip())
            ctes.append(f"b{d} AS (SELECT node, feature AS best FROM l{d}_g "
                        f"QUALIFY row_number() OVER (PARTITION BY node ORDER BY round({gain_col}, 12) DESC, feature_pos) = 1)")
            split = "CASE WHEN s.classes > 1 THEN b.best END"
            join_best = f"LEFT JOIN b{d} b ON s.node = b.node"
        else:
            split = "CAST(NULL AS VARCHAR)"
            join_best = ""
        ctes.append(f"n{d} AS (SELECT s.node AS node_path, CAST({d} AS INTEGER) AS depth, {split} AS split_attribute, "
                    f"s.n, CAST(s.classes = 1 AS INTEGER) AS is_pure, CAST(m.majority AS {out}) AS majority, "
                    f"s.mean_label, s.mean_first_column, "
                    + (f"CAST(m.majority AS {out})" if leaf == "majority" else f"CAST(s.{leaf} AS DOUBLE)")
                    + " AS leaf_value "
                    f"FROM s{d} s JOIN mj{d} m ON s.node = m.node {join_best})")
        node_names.append(f"n{d}")
        if d < depth:
            pick = "CASE n.split_attribute " + " ".join(f"WHEN '{f}' THEN r.{f}" for f in feats) + " END"
            ctes.append(f"r{d + 1} AS (SELECT r.* EXCLUDE (node, used), "
                        f"r.node || CASE WHEN r.node = '' THEN '' ELSE ' AND ' END || n.split_attribute || ' = ' "
                        f"|| coalesce({pick}, 'null') AS node, list_append(r.used, n.split_attribute) AS used "
                        f"FROM {r} r JOIN n{d} n ON r.node = n.node_path WHERE n.split_attribute IS NOT NULL)")
    ctes.append("nodes AS (" + " UNION ALL ".join(f"SELECT * FROM {n}" for n in node_names) + ")")
    if test_rel is not None:
        kc = "".join(f"{k}, " for k in keys)
        ctes.append(f"q0 AS (SELECT {kc}{label}, {fcols}, '' AS node, CAST(NULL AS DOUBLE) AS fb FROM {test_rel})")
        done = []
        for d in range(depth + 1):
            ctes.append(f"j{d} AS (SELECT q.*, n.split_attribute AS sa, n.leaf_value AS lv, n.node_path IS NOT NULL AS hit "
                        f"FROM q{d} q LEFT JOIN n{d} n ON q.node = n.node_path)")
            done.append(f"SELECT {kc}{label}, CASE WHEN hit THEN lv ELSE fb END AS prediction FROM j{d} "
                        f"WHERE NOT hit OR sa IS NULL")
            pick = "CASE sa " + " ".join(f"WHEN '{f}' THEN {f}" for f in feats) + " END"
            ctes.append(f"q{d + 1} AS (SELECT {kc}{label}, {', '.join(feats)}, node || CASE WHEN node = '' THEN '' "
                        f"ELSE ' AND ' END || sa || ' = ' || coalesce({pick}, 'null') AS node, lv AS fb FROM j{d} "
                        f"WHERE hit AND sa IS NOT NULL)")
        done.append(f"SELECT {kc}{label}, fb AS prediction FROM q{depth + 1}")
        ctes.append("pred AS (" + " UNION ALL ".join(done) + ")")
    # each step reads several earlier ones: without this they would be expanded again and again
    return re.sub(r"(?m)^(\w+) AS \(", r"\1 AS MATERIALIZED (", ",\n".join(ctes))


def _gain_cols(prefix: str = "") -> str:
    return (f"{prefix}feature, n, {rnd('label_entropy')} AS label_entropy, "
            f"{rnd('conditional_entropy')} AS conditional_entropy, {rnd('feature_entropy')} AS feature_entropy, "
            f"{rnd('gain')} AS gain, {rnd('gain_compat')} AS gain_compat, feature_pos")


F6 = C.INJURY_FEATURES
LBL = C.INJURY_LABEL


def _best(gain_col: str) -> str:
    return (f"WITH {gain_ctes(INJURY, F6, LBL)} SELECT feature AS best_attribute, {rnd(gain_col)} AS gain FROM g "
            f"QUALIFY row_number() OVER (ORDER BY round({gain_col}, 12) DESC, feature_pos) = 1")


def _means(compat: bool) -> str:
    cols = []
    for f in F6:
        m = f"avg({f})"
        if compat and f in C.INJURY_TRUNCATED:
            m = f"CAST(trunc(avg({f})) AS DOUBLE)"
        cols.append(f"{rnd(m)} AS mean_{f}")
    return f"SELECT {LBL}, count(*) AS n, {', '.join(cols)} FROM {INJURY} GROUP BY {LBL}"


def _stddev(compat: bool) -> str:
    centres = []
    for f in F6:
        c = f"trunc(avg({f}))" if compat and f in C.INJURY_TRUNCATED else f"avg({f})"
        centres.append(f"{c} AS c_{f}")
    sds = ", ".join(f"{rnd(f'sqrt(avg(pow(i.{f} - m.c_{f}, 2)))')} AS sd_{f}" for f in F6)
    return (f"WITH m AS (SELECT {LBL}, {', '.join(centres)} FROM {INJURY} GROUP BY {LBL}) "
            f"SELECT i.{LBL}, count(*) AS n, {sds} FROM {INJURY} i JOIN m ON i.{LBL} = m.{LBL} GROUP BY i.{LBL}")


REPORT = f"""WITH conf AS (SELECT label, prediction, count(*) AS n FROM {METRICS} GROUP BY ALL),
cls AS (SELECT label AS c FROM conf UNION SELECT prediction FROM conf),
pc AS (SELECT c,
    coalesce((SELECT sum(n) FROM conf WHERE label = c), 0) AS n_label,
    coalesce((SELECT sum(n) FROM conf WHERE prediction = c), 0) AS n_pred,
    coalesce((SELECT sum(n) FROM conf WHERE label = c AND prediction = c), 0) AS tp FROM cls),
pr AS (SELECT *, CASE WHEN n_pred > 0 THEN tp / n_pred ELSE 0 END AS p,
    CASE WHEN n_label > 0 THEN tp / n_label ELSE 0 END AS r FROM pc),
f AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f1 FROM pr),
rep AS (SELECT CAST(sum(n_label) AS BIGINT) AS n, {rnd('sum(tp) / sum(n_label)')} AS accuracy,
    {rnd('sum(p * n_label) / sum(n_label)')} AS weighted_precision,
    {rnd('sum(r * n_label) / sum(n_label)')} AS weighted_recall,
    {rnd('sum(f1 * n_label) / sum(n_label)')} AS weighted_f1 FROM f)"""


def _nb_model_ctes(rel: str, features, label: str, compat: bool, truncate=()) -> str:
    """CTE ``model``: label, n, prior, mean_f and var_f (default) or sd_f."""
    tr = f"SELECT CAST(trunc({label}) AS INTEGER) AS label, {', '.join(features)} FROM {rel} WHERE trunc({label}) IN (0, 1)"
    if not compat:
        stats = ", ".join(f"avg({f}) AS mean_{f}, var_pop({f}) AS var_{f}" for f in features)
        return (f"tr AS ({tr}), st AS (SELECT label, count(*) AS n, {stats} FROM tr GROUP BY label), "
                f"model AS (SELECT *, n / sum(n) OVER () AS prior FROM st)")
    centres = ", ".join(
        (f"CAST(trunc(avg({f})) AS DOUBLE)" if f in truncate else f"avg({f})") + f" AS mean_{f}" for f in features)
    sds = ", ".join(f"sqrt(avg(pow(t.{f} - c.mean_{f}, 2))) AS sd_{f}" for f in features)
    means = ", ".join(f"any_value(c.mean_{f}) AS mean_{f}" for f in features)
    return (f"tr AS ({tr}), c AS (SELECT label, count(*) AS n, {centres} FROM tr GROUP BY label), "
            f"st AS (SELECT t.label, any_value(c.n) AS n, {means}, {sds} FROM tr t JOIN c ON t.label = c.label GROUP BY t.label), "
            f"model AS (SELECT *, n / sum(n) OVER () AS prior FROM st)")


def _nb_score(features, cls: int, compat: bool, var_floor: float = 1e-9) -> str:
    m = f"m{cls}"
    terms = [f"ln({m}.prior)"]
    for f in features:
        if compat:
            s = f"{m}.sd_{f}"
            pdf = f"(exp(-pow(t.{f} - {m}.mean_{f}, 2) / ({s} * 2)) / sqrt({s} * (2 * pi())))"
            terms.append(f"(CASE WHEN {s} = 0 THEN CAST('nan' AS DOUBLE) WHEN {pdf} = 0 THEN CAST('-inf' AS DOUBLE) "
                         f"ELSE ln({pdf}) END)")
        else:
            v = f"greatest({m}.var_{f}, {var_floor!r})"
            terms.append(f"(ln({v} * (2 * pi())) * -0.5 - pow(t.{f} - {m}.mean_{f}, 2) / ({v} * 2))")
    return " + ".join(terms)


def _nb_predict(rel_split: str, features, label: str, keys, compat: bool, truncate=(), scores=True) -> str:
    ctes = _nb_model_ctes(f"(SELECT * FROM {rel_split} WHERE split = 0)", features, label, compat, truncate)
    s0, s1 = _nb_score(features, 0, compat), _nb_score(features, 1, compat)
    pred = ("CAST(CASE WHEN isnan(s1) OR isnan(s0) THEN 0 WHEN s1 > s0 THEN 1 ELSE 0 END AS DOUBLE)")
    extra = f", {rnd('s0')} AS score_0, {rnd('s1')} AS score_1" if scores else ""
    return (f"WITH {ctes}, m0 AS (SELECT * FROM model WHERE label = 0), m1 AS (SELECT * FROM model WHERE label = 1), "
            f"sc AS (SELECT t.*, {s0} AS s0, {s1} AS s1 FROM (SELECT * FROM {rel_split} WHERE split = 1) t, m0, m1) "
            f"SELECT {', '.join(keys)}, {label}, {pred} AS prediction{extra} FROM sc")


INJURY_SPLIT_90 = f"(SELECT *, {split_sql(C.SEED_90_10, C.INJURY_KEY, [0.9, 0.1])} AS split FROM {INJURY})"
INJURY_SPLIT_80 = f"(SELECT *, {split_sql(C.SEED_80_20, C.INJURY_KEY, [0.8, 0.2])} AS split FROM {INJURY})"
INJURY_SPLIT_70 = f"(SELECT *, {split_sql(C.SEED_70_30, C.INJURY_KEY, [0.7, 0.3])} AS split FROM {INJURY})"

_LONG_CARDS = f"""cards AS (SELECT hand_id, unnest([r1, r2, r3, r4, r5]) AS r FROM {HANDS}),
m AS (SELECT hand_id, r, count(*) AS mult FROM cards GROUP BY ALL),
o AS (SELECT *, row_number() OVER (PARTITION BY hand_id ORDER BY r) AS pos FROM m),
isl AS (SELECT hand_id, r - pos AS grp, count(*) AS len_d, 1 + sum(mult) - arg_min(mult, r) AS len_c FROM o GROUP BY ALL),
runs AS (SELECT i.hand_id, CAST(max(len_d) AS INTEGER) AS longest_run,
    CAST(CASE WHEN max(o1.mult) > 1 THEN NULL ELSE max(len_c) END AS INTEGER) AS longest_run_compat
  FROM isl i JOIN (SELECT hand_id, mult FROM o WHERE pos = 1) o1 ON i.hand_id = o1.hand_id GROUP BY i.hand_id)"""

_SUITS = f"""suits AS (SELECT hand_id, unnest([s1, s2, s3, s4, s5]) AS s FROM {HANDS}),
sc AS (SELECT hand_id, s, count(*) AS cnt FROM suits GROUP BY ALL),
bonus AS (SELECT hand_id, CAST(CASE WHEN max(cnt) = 4 THEN 25 ELSE 0 END AS INTEGER) AS flush_bonus,
    CAST(0 AS INTEGER) AS flush_bonus_compat FROM sc GROUP BY hand_id)"""

_CLASS_SCORE = "CAST(CASE WHEN class BETWEEN 1 AND 9 THEN (class + 1) * 1000 ELSE 1000 END AS DOUBLE)"
_RANK_POINTS = " + ".join(f"(CASE WHEN r{i} = 1 THEN 14 ELSE 14 - r{i} END)" for i in range(1, 6))

SCORE_HANDS = f"""WITH {_LONG_CARDS}, {_SUITS},
base AS (SELECT hand_id, class, {_CLASS_SCORE} AS class_score, CAST({_RANK_POINTS} AS INTEGER) AS rank_points FROM {HANDS})
SELECT b.hand_id, b.class, b.class_score, b.rank_points, x.flush_bonus, x.flush_bonus_compat, r.longest_run,
  r.longest_run_compat,
  {rnd('b.class_score + b.rank_points * b.class_score * 0.002 + x.flush_bonus + r.longest_run * 4')} AS total_score,
  {rnd('b.class_score + b.rank_points * b.class_score * 0.002 + x.flush_bonus_compat + r.longest_run_compat * 4')} AS total_score_compat
FROM base b JOIN bonus x ON b.hand_id = x.hand_id JOIN runs r ON b.hand_id = r.hand_id"""

def _tree_case() -> str:
    """The published tree as nested CASEs, by rewriting its lines one by one:
    an If opens a CASE, its Else is the ELSE, and a finished ELSE branch
    closes it."""
    out, open_ = [], []          # open_: True once a CASE is in its ELSE branch
    for line in PUBLISHED_TREE.splitlines():
        words = line.strip().strip("()").replace("(", "").split()
        if words[0] == "If":
            out.append(f"CASE WHEN {C.INJURY_FEATURES[int(words[2])]} {words[3]} {words[4]} THEN")
            open_.append(False)
        elif words[0] == "Else":
            out.append("ELSE")
            open_[-1] = True
        elif words[0] == "Predict:":
            out.append(f"CAST({words[1]} AS DOUBLE)")
            while open_ and open_[-1]:
                out.append("END")
                open_.pop()
    return " ".join(out)


_TREE = _tree_case()


def _value_prob() -> str:
    feats = C.CATEGORICAL_FEATURES
    sel = ", ".join(f"CAST({f} AS VARCHAR) AS {f}" for f in feats)
    return (f"WITH long AS (UNPIVOT (SELECT {sel} FROM {INJURY}) ON {', '.join(feats)} INTO NAME feature VALUE value), "
            f"c AS (SELECT feature, value, count(*) AS n FROM long GROUP BY ALL), "
            f"p AS (SELECT *, n / sum(n) OVER (PARTITION BY feature) AS pr FROM c) "
            f"SELECT feature, value, n, {rnd('pr')} AS probability, {rnd('-pr * ln(pr)')} AS entropy_term FROM p")


def _feature_value_counts() -> str:
    feats = C.CATEGORICAL_FEATURES + ["Training_Intensity"]
    sel = ", ".join(f"{_key_str(f, f in DOUBLE_FEATURES)} AS {f}" for f in feats)
    return (f"SELECT feature, value, count(*) AS n FROM (UNPIVOT (SELECT {sel} FROM {INJURY}) ON {', '.join(feats)} "
            f"INTO NAME feature VALUE value) GROUP BY ALL")


def _binned_rel(rel: str, features, bins: int, edges_rel: str | None = None) -> str:
    """``rel`` with each feature replaced by its equal-width bin (the first
    two columns as they were under ``raw_...``); edges from ``edges_rel``
    (default: ``rel`` itself)."""
    edges_rel = edges_rel or rel
    x = {f: f"CAST(r.{f} AS DOUBLE)" for f in features}
    edges = ", ".join(f"min(CASE WHEN isnan({x[f]}) THEN NULL ELSE {x[f]} END) AS lo_{f}, "
                      f"max(CASE WHEN isnan({x[f]}) THEN NULL ELSE {x[f]} END) AS hi_{f}" for f in features)
    repl = ", ".join(
        f"CAST(CASE WHEN r.{f} IS NULL OR isnan({x[f]}) THEN NULL WHEN hi_{f} = lo_{f} THEN 0 ELSE "
        f"least(greatest(floor(({x[f]} - lo_{f}) / ((hi_{f} - lo_{f}) / {bins})), 0), {bins - 1}) END AS INTEGER) AS {f}"
        for f in features)
    return (f"(SELECT r.* REPLACE ({repl}), r.Player_Age AS raw_age FROM {rel} r, "
            f"(SELECT {edges} FROM {edges_rel} r) e)")


_BINNED = _binned_rel(INJURY, F6, C.GAIN_BINS)

# the CSV scans read back what was written from the injury view
_CSV_SCAN = "SELECT " + ", ".join(
    rnd(c) + f" AS {c}" if c in DOUBLE_FEATURES else c for c in INJURY_COLUMNS) + f" FROM {INJURY}"

_ID3_TRAIN = f"(SELECT * FROM {INJURY_SPLIT_70} WHERE split = 0)"
_ID3_TEST = f"(SELECT * FROM {INJURY_SPLIT_70} WHERE split = 1)"


def _id3_sql(bins, **kw) -> str:
    if bins is None:
        return id3_ctes(_ID3_TRAIN, _ID3_TEST, F6, LBL, "l_orderkey", C.ID3_DEPTH, C.INJURY_KEY, **kw)
    return id3_ctes(_binned_rel(_ID3_TRAIN, F6, bins), _binned_rel(_ID3_TEST, F6, bins, _ID3_TRAIN), F6, LBL,
                    kw.pop("first", "l_orderkey"), C.ID3_DEPTH, C.INJURY_KEY, **kw)


_ID3 = _id3_sql(C.ID3_BINS)
_ID3C = _id3_sql(C.ID3_BINS, first="raw_age", gain_col="gain_compat", leaf="mean_first_column")
_ID3B = _id3_sql(C.ID3_FEW_BINS)
_ID3D = _id3_sql(None)
_NODE_COLS = (f"node_path, depth, split_attribute, n, is_pure, majority, {rnd('mean_label')} AS mean_label, "
              f"{rnd('mean_first_column')} AS mean_first_column, leaf_value")

def _threshold_gain(bins: int) -> str:
    """The best of ``bins - 1`` equal-width cuts of each feature, every cut
    counted over all rows."""
    x = {f: f"CAST({f} AS DOUBLE)" for f in F6}
    long = " UNION ALL ".join(f"SELECT '{f}' AS feature, {k} AS feature_pos, {x[f]} AS v, {LBL} AS y FROM r" for k, f in enumerate(F6))
    ent = lambda a, b: f"(CASE WHEN {a} > 0 THEN {a} * ln({a}) ELSE 0 END - {b})"
    return (f"WITH r AS (SELECT * FROM {INJURY}), long AS (SELECT * FROM ({long}) WHERE v IS NOT NULL AND NOT isnan(v)), "
            f"e AS (SELECT feature, min(v) AS lo, max(v) AS hi FROM long GROUP BY feature), "
            f"cuts AS (SELECT feature, lo + (hi - lo) / {bins} * i AS threshold FROM e, range(1, {bins}) t(i) WHERE hi > lo), "
            f"cells AS (SELECT feature, feature_pos, v, y, count(*) AS n FROM long GROUP BY ALL), "
            f"k AS (SELECT c.feature, c.feature_pos, threshold, y, sum(n) AS al, coalesce(sum(n) FILTER (v < threshold), 0) AS lf "
            f"FROM cells c JOIN cuts USING (feature) GROUP BY ALL), "
            f"s AS (SELECT feature, feature_pos, threshold, sum(al)::DOUBLE AS n, sum(lf)::DOUBLE AS l, "
            f"sum(al * ln(al)) AS sa, sum(CASE WHEN lf > 0 THEN lf * ln(lf) ELSE 0 END) AS sl, "
            f"sum(CASE WHEN al > lf THEN (al - lf) * ln(al - lf) ELSE 0 END) AS sr FROM k GROUP BY ALL), "
            f"g AS (SELECT *, greatest(0, ({ent('n', 'sa')} - {ent('l', 'sl')} - {ent('(n - l)', 'sr')}) / n / ln(2)) AS gain FROM s) "
            f"SELECT feature, CAST(feature_pos AS INTEGER) AS feature_pos, {rnd('threshold')} AS threshold, CAST(n AS BIGINT) AS n, "
            f"CAST(l AS BIGINT) AS n_below, {rnd('gain')} AS gain FROM g "
            f"QUALIFY row_number() OVER (PARTITION BY feature ORDER BY round(gain, 12) DESC, threshold) = 1")


ORACLE = {
    "last_column_label": _best("gain"),
    "threshold_gain_width": _threshold_gain(32),
    "threshold_gain_check": " UNION ALL ".join(
        f"SELECT '{f}' AS feature, count({f}) AS n, CAST(0 AS BIGINT) AS wide_bins, CAST(0 AS BIGINT) AS miscounted FROM {INJURY}"
        for f in F6),
    "mllib_tree_split_check": f"SELECT count(*) AS n_root, count(*) AS n_leaves, CAST(0 AS BIGINT) AS impurity_off, "
                              f"CAST(0 AS BIGINT) AS gain_off, CAST(0 AS BIGINT) AS prediction_off FROM {INJURY_SPLIT_70} "
                              f"WHERE split = 0",
    "mllib_tree_rules_check": "SELECT CAST(0 AS BIGINT) AS differences, CAST(0 AS BIGINT) AS unnamed, TRUE AS feature_10, "
                              "TRUE AS feature_11",
    "logistic_score_check": f"SELECT count(*) AS n_test, CAST(0 AS BIGINT) AS score_off, CAST(0 AS BIGINT) AS probability_off, "
                            f"CAST(0 AS BIGINT) AS prediction_off, CAST(0 AS BIGINT) AS area_off, "
                            f"CAST(sum({LBL}) AS BIGINT) AS n_positive FROM {INJURY_SPLIT_80} WHERE split = 1",
    "parse_records": f"SELECT " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in INJURY_COLUMNS)
                     + f" FROM {INJURY} WHERE l_orderkey % 13 > 2 AND " + " AND ".join(f"{c} IS NOT NULL" for c in INJURY_COLUMNS),
    "parse_hands": f"SELECT * EXCLUDE (hand_id) FROM {HANDS} WHERE hand_id % 17 > 2",
    "scan_csv_schema": _CSV_SCAN,
    "scan_csv_header": _CSV_SCAN,
    "scan_csv_positional": _CSV_SCAN,
    "filter_complete_rows": "SELECT event_id, user_id, event_type, value, props FROM events WHERE event_id IS NOT NULL "
                            "AND user_id IS NOT NULL AND event_type IS NOT NULL AND value IS NOT NULL AND props IS NOT NULL "
                            "AND event_id % 7 <> 0 AND event_id % 11 <> 3",
    "class_partition": f"SELECT {INJURY_KEY}, Player_Age, {rnd('Player_Weight')} AS Player_Weight, {LBL} FROM {INJURY} "
                       f"WHERE CAST(trunc({LBL}) AS INTEGER) = 1",
    "split_by_value": f"SELECT {INJURY_KEY}, Player_Age, Recovery_Time, {LBL} FROM {INJURY} "
                      f"WHERE Recovery_Time IS NOT DISTINCT FROM 3",
    "attach_predictions": f"SELECT e.event_id, e.label, m.prediction FROM {EVENTS} e JOIN {METRICS} m ON e.event_id = m.event_id",
    "split_90_10": f"SELECT event_id, {split_sql(C.SEED_90_10, ['event_id'], [0.9, 0.1])} AS split FROM {EVENTS}",
    "split_80_20": f"SELECT event_id, {split_sql(C.SEED_80_20, ['event_id'], [0.8, 0.2])} AS split FROM {EVENTS}",
    "split_70_30": f"SELECT event_id, {split_sql(C.SEED_70_30, ['event_id'], [0.7, 0.3])} AS split FROM {EVENTS}",
    "class_counts": "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY c_mktsegment",
    "class_probability": f"SELECT class, count(*) AS n, {rnd('count(*) / sum(count(*)) OVER ()')} AS probability "
                         f"FROM {HANDS} GROUP BY class",
    "class_priors": f"SELECT {LBL}, n, {rnd('n / sum(n) OVER ()')} AS prior FROM (SELECT CAST(trunc({LBL}) AS INTEGER) "
                    f"AS {LBL}, count(*) AS n FROM {INJURY} WHERE trunc({LBL}) IN (0, 1) GROUP BY 1)",
    "feature_value_counts": _feature_value_counts(),
    "value_probability": _value_prob(),
    "distinct_values": f"SELECT DISTINCT Recovery_Time FROM {INJURY}",
    "label_entropy": f"WITH c AS (SELECT {LBL}, count(*) AS n FROM {INJURY} GROUP BY 1), t AS (SELECT sum(n) AS nn FROM c) "
                     f"SELECT CAST(any_value(nn) AS BIGINT) AS n, {rnd('greatest(-sum((n / nn) * ln(n / nn)) / ln(2), 0)')} "
                     f"AS entropy FROM c, t",
    "information_gain": f"WITH {gain_ctes(INJURY, F6, LBL)} SELECT feature, {rnd('gain')} AS gain FROM g",
    "information_gain_compat": f"WITH {gain_ctes(INJURY, F6, LBL)} SELECT feature, {rnd('gain_compat')} AS gain FROM g",
    "gain_report": f"WITH {gain_ctes(INJURY, F6, LBL)} SELECT {_gain_cols()} FROM g",
    "gain_report_binned": f"WITH {gain_ctes(_BINNED, F6, LBL, double_features=())} SELECT {_gain_cols()} FROM g",
    "gain_report_by_split": f"WITH {gain_ctes(INJURY_SPLIT_70, F6, LBL, ['split'])} SELECT {_gain_cols('split, ')} FROM g",
    "best_attribute": _best("gain"),
    "best_attribute_compat": _best("gain_compat"),
    "class_means": _means(False),
    "class_means_compat": _means(True),
    "class_stddev": _stddev(False),
    "class_stddev_compat": _stddev(True),
    "is_pure": f"SELECT user_id, hour, count(*) AS n, CAST(count(DISTINCT label) = 1 AS INTEGER) AS is_pure FROM {EVENTS} "
               f"GROUP BY user_id, hour",
    "leaf_values_text": f"""WITH c AS (SELECT o_orderpriority AS p, o_orderstatus AS s, count(*) AS cnt, sum(o_totalprice) AS v
          FROM orders GROUP BY ALL),
        mj AS (SELECT p, s AS majority FROM c QUALIFY row_number() OVER (PARTITION BY p ORDER BY cnt DESC, s) = 1)
        SELECT p AS o_orderpriority, CAST(sum(cnt) AS BIGINT) AS n, any_value(majority) AS majority,
          CAST(NULL AS DOUBLE) AS mean_label, {rnd('sum(v) / sum(cnt)', 2)} AS mean_first_column
        FROM c JOIN mj USING (p) GROUP BY p""",
    "leaf_values": f"""WITH c AS (SELECT user_id, label, count(*) AS cnt, sum(value) AS sv FROM {EVENTS} GROUP BY ALL),
        mj AS (SELECT user_id, label AS majority FROM c QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY cnt DESC, label) = 1)
        SELECT user_id, CAST(sum(cnt) AS BIGINT) AS n, any_value(majority) AS majority,
          {rnd('sum(label * cnt) / sum(cnt)')} AS mean_label, {rnd('sum(sv) / sum(cnt)')} AS mean_first_column
        FROM c JOIN mj USING (user_id) GROUP BY user_id""",
    "accuracy": f"SELECT {rnd('avg(CASE WHEN prediction = label THEN 1 ELSE 0 END)')} AS accuracy FROM {METRICS}",
    "accuracy_pct": f"SELECT {rnd('avg(CASE WHEN prediction = label THEN 1 ELSE 0 END) * 100')} AS accuracy_pct FROM {METRICS}",
    "precision_pct": f"SELECT {rnd('CASE WHEN count_if(prediction = 1) = 0 THEN 0 ELSE count_if(prediction = 1 AND label = 1) / count_if(prediction = 1) * 100 END')} AS precision_pct FROM {METRICS}",
    "weighted_precision": f"{REPORT} SELECT weighted_precision FROM rep",
    "weighted_recall": f"{REPORT} SELECT weighted_recall FROM rep",
    "weighted_f1": f"{REPORT} SELECT weighted_f1 FROM rep",
    "classification_report": f"{REPORT} SELECT * FROM rep",
    "area_under_roc": f"""WITH s AS (SELECT score, count_if(label = 1) AS pos, count_if(label <> 1) AS neg FROM {METRICS}
          WHERE score IS NOT NULL AND label IS NOT NULL GROUP BY score),
        c AS (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM s)
        SELECT {rnd('sum(CAST(pos AS DOUBLE) * (nb + 0.5 * neg)) / (CAST(sum(pos) AS DOUBLE) * sum(neg))')} AS area_under_roc,
          CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg FROM c""",
    "area_under_roc_extremes": f"""WITH s AS (SELECT score, count_if(label = 1) AS pos, count_if(label <> 1) AS neg FROM (SELECT CASE WHEN value > 150 THEN CAST('inf' AS DOUBLE) WHEN value < 20 THEN CAST('-inf' AS DOUBLE)
            ELSE value END AS score, label FROM {EVENTS})
          WHERE score IS NOT NULL AND label IS NOT NULL GROUP BY score),
        c AS (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM s)
        SELECT {rnd('sum(CAST(pos AS DOUBLE) * (nb + 0.5 * neg)) / (CAST(sum(pos) AS DOUBLE) * sum(neg))')} AS area_under_roc,
          CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg FROM c""",
    "gaussian_density": f"SELECT {INJURY_KEY}, {rnd(f'exp(-pow(Player_Weight - {C.DENSITY_MEAN!r}, 2) / ({C.DENSITY_VAR!r} * 2)) / sqrt({C.DENSITY_VAR!r} * (2 * pi()))', 9)} AS density FROM {INJURY}",
    "gaussian_nb_fit": (f"WITH {_nb_model_ctes(f'(SELECT * FROM {DOC_SPLIT} WHERE split = 0)', C.DOC_FEATURES, 'label', False)} "
                        f"SELECT label, n, {rnd('prior')} AS prior, "
                        + ", ".join(f"{rnd(f'mean_{f}')} AS mean_{f}, {rnd(f'var_{f}')} AS var_{f}" for f in C.DOC_FEATURES)
                        + " FROM model"),
    "gaussian_nb_predict": _nb_predict(DOC_SPLIT, C.DOC_FEATURES, "label", ["doc_id"], False),
    "gaussian_nb_predict_compat": _nb_predict(INJURY_SPLIT_90, F6, LBL, C.INJURY_KEY, True, C.INJURY_TRUNCATED, scores=False),
    "gaussian_nb_end_to_end": f"""WITH p AS ({_nb_predict(DOC_SPLIT, C.DOC_FEATURES, "label", ["doc_id"], False, scores=False)}),
        tr AS (SELECT count(*) AS n_train FROM {DOC_SPLIT} WHERE split = 0 AND trunc(label) IN (0, 1))
        SELECT CAST(any_value(n_train) AS BIGINT) AS n_train, count(*) AS n_test,
          {rnd('avg(CASE WHEN prediction = label THEN 1 ELSE 0 END) * 100')} AS accuracy_pct,
          {rnd('CASE WHEN count_if(prediction = 1) = 0 THEN 0 ELSE count_if(prediction = 1 AND label = 1) / count_if(prediction = 1) * 100 END')} AS precision_pct
        FROM p, tr""",
    "index_label": f"""SELECT label_value, n, CAST(row_number() OVER (ORDER BY n DESC, label_value) - 1 AS DOUBLE) AS label_index
        FROM (SELECT CAST({LBL} AS VARCHAR) AS label_value, count(*) AS n FROM {INJURY} WHERE {LBL} IS NOT NULL GROUP BY 1)""",
    "rule_tree_predict": f"SELECT {INJURY_KEY}, {_TREE} AS prediction FROM {INJURY}",
    "hand_class_score": f"SELECT hand_id, class, {_CLASS_SCORE} AS class_score FROM {HANDS}",
    "hand_rank_points": f"SELECT hand_id, CAST({_RANK_POINTS} AS INTEGER) AS rank_points FROM {HANDS}",
    "hand_longest_run": f"WITH {_LONG_CARDS} SELECT hand_id, longest_run, longest_run_compat FROM runs",
    "hand_flush_bonus": f"WITH {_SUITS} SELECT hand_id, flush_bonus, flush_bonus_compat FROM bonus",
    "score_hands": SCORE_HANDS,
    "id3_build": f"WITH {_ID3} SELECT {_NODE_COLS} FROM nodes",
    "id3_rules": f"WITH {_ID3} SELECT node_path AS rule, depth, n, leaf_value AS prediction FROM nodes "
                 f"WHERE split_attribute IS NULL",
    "id3_predict": f"WITH {_ID3} SELECT * FROM pred",
    "id3_build_binned": f"WITH {_ID3B} SELECT {_NODE_COLS} FROM nodes",
    "id3_build_deep": f"WITH {_ID3D} SELECT {_NODE_COLS} FROM nodes",
    "id3_predict_deep": f"WITH {_ID3D} SELECT * FROM pred",
    "id3_build_text": "WITH " + id3_ctes("(SELECT *, CAST(month(o_orderdate) AS INTEGER) AS month FROM orders)", None,
                                         ["o_orderpriority", "month"], "o_orderstatus", "o_totalprice", 2,
                                         text_label=True)
                      + f" SELECT node_path, depth, split_attribute, n, is_pure, majority, mean_label, "
                        f"{rnd('mean_first_column', 2)} AS mean_first_column, leaf_value FROM nodes",
    "mllib_tree_check": f"SELECT split, count(*) AS n, CAST(0 AS BIGINT) AS disagreements, CAST(0 AS BIGINT) AS "
                        f"without_prediction FROM {INJURY_SPLIT_70} GROUP BY split",
    "logistic_check": f"SELECT count(*) AS n_train, "
                      + ", ".join(f"CAST(0 AS DOUBLE) AS gradient_{c}" for c in ("intercept", *F6))
                      + f" FROM {INJURY_SPLIT_80} WHERE split = 0",
    "predicted_keys": f"SELECT 'tree' AS model, {INJURY_KEY}, {LBL} FROM {INJURY_SPLIT_70} WHERE split = 1 "
                      f"UNION ALL SELECT 'logistic', {INJURY_KEY}, {LBL} FROM {INJURY_SPLIT_80} WHERE split = 1",
    "random_split_check": "SELECT count(*) AS n, CAST(1 AS BIGINT) AS most, CAST(1 AS BIGINT) AS sides, "
                          "count(DISTINCT event_id) AS keys FROM events",
    "id3_predict_binned": f"WITH {_ID3B} SELECT * FROM pred",
    "id3_build_compat": f"WITH {_ID3C} SELECT {_NODE_COLS.replace('leaf_value', rnd('leaf_value') + ' AS leaf_value')} FROM nodes",
    "id3_predict_compat": f"WITH {_ID3C} SELECT {INJURY_KEY}, {LBL}, {rnd('prediction')} AS prediction FROM pred",
    "best_attribute_by_split": (f"WITH {gain_ctes(INJURY_SPLIT_70, F6, LBL, ['split'])} SELECT split, feature AS best_attribute, "
                                f"{rnd('gain')} AS gain FROM g "
                                f"QUALIFY row_number() OVER (PARTITION BY split ORDER BY round(gain, 12) DESC, feature_pos) = 1"),
    "id3_accuracy": f"WITH {_ID3} SELECT {rnd(f'avg(CASE WHEN prediction = {LBL} THEN 1 ELSE 0 END)')} AS accuracy FROM pred",
}
