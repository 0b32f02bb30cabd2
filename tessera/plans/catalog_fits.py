"""Catalogue part 7: fits from sufficient statistics, with the solvers written out in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..models import bayes, moments, stacking
from ..operators import target
from ..operators.order import hash_hex
from .frames import (MODEL_FEATURES, MODEL_FRAME_SQL, NULLED_LINEITEM_SQL, RK, hdigit, hdigit_sql, model_frame, nulled_lineitem,
                     round_doubles, table)
from .registry import query

# fixed values: the penalty grid of the regularised regressions
ALPHAS = [0.0005, 0.001, 0.005, 0.01, 0.05, 0.1, 0.2, 0.5, 1.0, 2.0, 5.0, 8.0, 10.0, 12.0, 15.0, 18.0, 20.0, 50.0, 100.0, 1000.0]
FOLDS = 5
D = len(MODEL_FEATURES)


def _folded(spark, d):
    """The modelling table with five folds from the key's hash."""
    fold = F.pmod(F.conv(F.substring(hash_hex("rid", "moments"), 1, 4), 16, 10).cast("int"), F.lit(FOLDS))
    return model_frame(spark, d).withColumn("fold", fold)


_PARTS = [(i, j) for i in range(D + 1) for j in range(i, D + 1)]
_Z = [*MODEL_FEATURES, "y_reg"]
#: per fold f: the sums n, s, q of the training rows (t) and of the held-out rows (h)
_SUMS = f"""
m AS MATERIALIZED (SELECT *, ('0x' || substr(md5('moments:' || rid), 1, 4))::INTEGER % {FOLDS} AS fold FROM ({MODEL_FRAME_SQL})),
h AS MATERIALIZED (SELECT fold, count(*)::DOUBLE AS n, {', '.join(f'sum({z}) AS s{i}' for i, z in enumerate(_Z))},
  {', '.join(f'sum({_Z[i]} * {_Z[j]}) AS q{i}{j}' for i, j in _PARTS)} FROM m GROUP BY fold),
t AS MATERIALIZED (SELECT h.fold, sum(o.n) AS n, {', '.join(f'sum(o.s{i}) AS s{i}' for i in range(D + 1))},
  {', '.join(f'sum(o.q{i}{j}) AS q{i}{j}' for i, j in _PARTS)} FROM h JOIN h o ON o.fold <> h.fold GROUP BY h.fold),
c AS MATERIALIZED (SELECT fold, n, {', '.join(f's{i} / n AS m{i}' for i in range(D + 1))},
  {', '.join(f'q{i}{j} - s{i} * s{j} / n AS g{i}{j}' for i, j in _PARTS)} FROM t)"""


def _g(i, j):
    return f"g{min(i, j)}{max(i, j)}"


def _errors(source: str) -> str:
    """(candidate, fold, n, rmse) of lines w0.. (through the training means) on the held-out sums."""
    v = [f"(-w{i})" for i in range(D)] + ["1"]
    b = f"(m{D} - " + " - ".join(f"w{i} * m{i}" for i in range(D)) + ")"
    quad = " + ".join(f"{1 if i == j else 2} * {v[i]} * {v[j]} * h.q{i}{j}" for i, j in _PARTS)
    lin = " + ".join(f"{v[i]} * h.s{i}" for i in range(D + 1))
    return f"""SELECT w.candidate, w.fold, CAST(h.n AS BIGINT) AS n,
  round(sqrt(greatest({quad} - 2 * {b} * ({lin}) + h.n * {b} * {b}, 0) / h.n), 6) AS rmse
FROM {source} w JOIN h ON h.fold = w.fold JOIN c ON c.fold = w.fold"""


def _ridge_sql() -> str:
    """Gaussian elimination of (X'X + alpha I) w = X'y, one step per table."""
    sql = f"""WITH {_SUMS},
e0 AS (SELECT fold, candidate, {', '.join(f'{_g(i, j)}' + (' + alpha' if i == j else '') + f' AS a{i}{j}' for i in range(D) for j in range(D))},
  {', '.join(f'{_g(i, D)} AS b{i}' for i in range(D))}
  FROM c CROSS JOIN (VALUES {', '.join(f'({i}, {a})' for i, a in enumerate(ALPHAS))}) p(candidate, alpha))"""
    for k in range(D):
        cols = []
        for i in range(D):
            f = "" if i <= k else f" - a{i}{k} / a{k}{k} * "
            cols += [f"a{i}{j}" + (f"{f}a{k}{j}" if f else "") + f" AS a{i}{j}" for j in range(D)] + [f"b{i}" + (f"{f}b{k}" if f else "") + f" AS b{i}"]
        sql += f",\ne{k + 1} AS (SELECT fold, candidate, {', '.join(cols)} FROM e{k})"
    back, source = [], f"e{D}"
    for i in reversed(range(D)):
        expr = f"(b{i}" + "".join(f" - a{i}{j} * w{j}" for j in range(i + 1, D)) + f") / a{i}{i}"
        sql += f",\nu{i} AS (SELECT *, {expr} AS w{i} FROM {source})"
        source = f"u{i}"
    return sql + "\n" + _errors(source)


def _descent_sql(alphas, ratio: float, steps: int) -> str:
    """Coordinate descent as a recursive table, a cycle over the coefficients per step."""
    new = []
    for j in range(D):
        r = f"({_g(j, D)} / n" + "".join(f" - {_g(j, k)} / n * {f'v{k}' if k < j else f'w{k}'}" for k in range(D) if k != j) + ")"
        new.append(f"sign({r}) * greatest(abs({r}) - alpha * {ratio}, 0) / ({_g(j, j)} / n + alpha * {1 - ratio}) AS v{j}")
    step = "SELECT w.fold, w.candidate, w.alpha, w.step, " + ", ".join(f"w{j}" for j in range(D)) + ", c.* EXCLUDE (fold) FROM walk w JOIN c ON c.fold = w.fold"
    inner = f"({step})"
    for j in range(D):
        inner = f"(SELECT *, {new[j]} FROM {inner})"
    return f"""WITH RECURSIVE {_SUMS},
walk AS (SELECT fold, candidate, alpha::DOUBLE AS alpha, 0 AS step, {', '.join(f'0::DOUBLE AS w{j}' for j in range(D))}
  FROM c CROSS JOIN (VALUES {', '.join(f'({i}, {a})' for i, a in enumerate(alphas))}) p(candidate, alpha)
  UNION ALL SELECT fold, candidate, alpha, step + 1, {', '.join(f'v{j}' for j in range(D))} FROM {inner} WHERE step < {steps}),
last AS (SELECT * FROM walk WHERE step = {steps})
""" + _errors("last")


def _cv(spark, d, kind, cands):
    rec, table, _ = moments.linear_grid_search(_folded(spark, d), None, MODEL_FEATURES, cands, kind=kind, label="y_reg")
    return round_doubles(table.select("candidate", "fold", F.col("n"), "rmse"))


@query("ridge_grid_by_moments", _ridge_sql())
def ridge_grid_by_moments(spark, d):
    """V8 + V10 + L9: 20 penalties x 5 folds from one scan."""
    return _cv(spark, d, "ridge", [{"alpha": a} for a in ALPHAS])


@query("lasso_grid_by_moments", _descent_sql(ALPHAS[:8], 1.0, 300))
def lasso_grid_by_moments(spark, d):
    """V8 + V10 + L10: 8 penalties x 5 folds from one scan."""
    return _cv(spark, d, "lasso", [{"alpha": a} for a in ALPHAS[:8]])


@query("elastic_net_grid_by_moments", _descent_sql(ALPHAS[:8], 0.9, 300))
def elastic_net_grid_by_moments(spark, d):
    """V8 + V10 + L11: 8 penalties x 5 folds, L1 share 0.9, from one scan."""
    return _cv(spark, d, "elastic_net", [{"alpha": a, "l1_ratio": 0.9} for a in ALPHAS[:8]])


# ------------------------------------------------------------------ out-of-fold encoding, stacking, pruning
def _encoded_rows(spark, d):
    li = nulled_lineitem(spark, d)
    rk = F.col("l_orderkey") * 100 + F.col("l_linenumber")
    fold = F.pmod(F.conv(F.substring(hash_hex(rk, "enc"), 1, 4), 16, 10).cast("int"), F.lit(FOLDS))
    return li.select(rk.alias("rk"), "l_returnflag", "l_partkey", fold.alias("fold"), (F.col("l_discount") > 0.05).cast("double").alias("y"))


_ENC = f"""e AS MATERIALIZED (SELECT {RK} AS rk, l_returnflag, l_partkey,
  ('0x' || substr(md5('enc:' || CAST({RK} AS VARCHAR)), 1, 4))::INTEGER % {FOLDS} AS fold,
  CASE WHEN l_discount > 0.05 THEN 1.0 WHEN l_discount IS NOT NULL THEN 0.0 END::DOUBLE AS y FROM ({NULLED_LINEITEM_SQL})),
f AS MATERIALIZED (SELECT a.fold, sum(e.y) / count(e.y) AS prior FROM (SELECT DISTINCT fold FROM e) a JOIN e ON e.fold <> a.fold GROUP BY a.fold)"""


def _encoded(col: str, name: str, smoothing: float) -> tuple[str, str]:
    """(value, joins) of one encoded column."""
    t, o = f"t_{col}", f"o_{col}"
    return (f"round((coalesce({t}.s, 0) - coalesce({o}.s, 0) + {smoothing} * f.prior) / (coalesce({t}.n, 0) - coalesce({o}.n, 0) + {smoothing}), 6) AS {name}",
            f"""LEFT JOIN (SELECT {col} AS c, sum(y) AS s, count(y) AS n FROM e GROUP BY {col}) {t} ON {t}.c IS NOT DISTINCT FROM e.{col}
  LEFT JOIN (SELECT {col} AS c, fold, sum(y) AS s, count(y) AS n FROM e GROUP BY {col}, fold) {o}
    ON {o}.c IS NOT DISTINCT FROM e.{col} AND {o}.fold = e.fold""")


_ENCODED = [_encoded("l_returnflag", "flag_target", 10.0), _encoded("l_partkey", "part_target", 5.0)]


@query("target_encode_out_of_fold", f"""WITH {_ENC}
SELECT e.rk, {', '.join(v for v, _ in _ENCODED)} FROM e JOIN f ON f.fold = e.fold
{' '.join(j for _, j in _ENCODED)}""")
def target_encode_out_of_fold(spark, d):
    """A hot level with nulls (return flag) and a wide one (part), each without its own fold's labels."""
    rows = _encoded_rows(spark, d)
    rows = target.fit_target_encoding(rows, "l_returnflag", "y", "fold", 10.0).transform_train(rows, "flag_target")
    rows = target.fit_target_encoding(rows, "l_partkey", "y", "fold", 5.0).transform_train(rows, "part_target")
    return round_doubles(rows.select("rk", "flag_target", "part_target"))


_PRUNE = ["l_quantity", "l_extendedprice", "double_quantity", "price_per_unit", "net_price", "l_discount", "l_tax"]
_PRUNE_SQL = """SELECT l_quantity::DOUBLE AS l_quantity, l_extendedprice::DOUBLE AS l_extendedprice, 2.0 * l_quantity + 1 AS double_quantity,
  l_extendedprice / l_quantity AS price_per_unit, l_extendedprice * (1 - l_discount) AS net_price, l_discount::DOUBLE AS l_discount,
  l_tax::DOUBLE AS l_tax FROM lineitem"""


def _prune_sql(threshold: float) -> str:
    n = len(_PRUNE)
    corr = ", ".join(f"corr({_PRUNE[i]}, {_PRUNE[j]}) AS r{i}_{j}" for j in range(n) for i in range(j))
    edges = " UNION ALL ".join(f"SELECT {i} AS i, {j} AS j, r{i}_{j} AS r FROM c" for j in range(n) for i in range(j))
    names = ", ".join(f"({i}, '{c}')" for i, c in enumerate(_PRUNE))
    return f"""WITH RECURSIVE p AS MATERIALIZED ({_PRUNE_SQL}), c AS MATERIALIZED (SELECT {corr} FROM p), e AS MATERIALIZED ({edges}),
walk(pos, kept) AS (SELECT 0, [0] UNION ALL
  SELECT pos + 1, CASE WHEN EXISTS (SELECT 1 FROM e WHERE e.j = pos + 1 AND list_contains(kept, e.i) AND abs(e.r) > {threshold}) THEN kept
                       ELSE list_append(kept, pos + 1) END FROM walk WHERE pos + 1 < {n}),
last AS (SELECT kept FROM walk WHERE pos = {n - 1}),
w AS (SELECT j, min(i) AS i FROM e CROSS JOIN last WHERE list_contains(kept, i) AND abs(r) > {threshold} GROUP BY j)
SELECT n.name AS "column", n.pos AS position, list_contains(kept, n.pos) AS kept, b.name AS because, round(e.r, 6) AS r
FROM (VALUES {names}) n(pos, name) CROSS JOIN last
LEFT JOIN w ON w.j = n.pos AND NOT list_contains(kept, n.pos) LEFT JOIN e ON e.i = w.i AND e.j = w.j
LEFT JOIN (VALUES {names}) b(pos, name) ON b.pos = w.i"""


@query("prune_correlated_columns", _prune_sql(0.9))
def prune_correlated_columns(spark, d):
    """Greedy pruning of |r| > 0.9 in column order."""
    li = table(spark, d, "lineitem")
    q, p = F.col("l_quantity").cast("double"), F.col("l_extendedprice").cast("double")
    wide = li.select(q.alias("l_quantity"), p.alias("l_extendedprice"), (2.0 * q + 1).alias("double_quantity"), (p / q).alias("price_per_unit"),
                     (p * (1 - F.col("l_discount"))).alias("net_price"), F.col("l_discount").cast("double"), F.col("l_tax").cast("double"))
    return round_doubles(target.prune_correlated(wide, _PRUNE, 0.9))


_STACK_ALPHA, _META_ALPHA = 50.0, 1.0


def _nb_p(stats: str) -> str:
    """P(class 1) under Gaussian naive Bayes on (q, tax) from columns of ``stats``."""
    lj = {k: f"ln({stats}.n{k} / ({stats}.n0 + {stats}.n1)) + " + " + ".join(
        f"(-0.5 * ln(2 * pi() * ({stats}.v{k}_{c} + {stats}.eps)) - (r.{c} - {stats}.m{k}_{c}) ** 2 / (2 * ({stats}.v{k}_{c} + {stats}.eps)))"
        for c in ("q", "tax")) for k in (0, 1)}
    return f"1 / (1 + exp(({lj[0]}) - ({lj[1]})))"


_FIRST = ", ".join([f"count(*) FILTER (WHERE label = {k})::DOUBLE AS n{k}" for k in (0, 1)]
                   + [f"avg({c}) FILTER (WHERE label = {k}) AS m{k}_{c}, var_pop({c}) FILTER (WHERE label = {k}) AS v{k}_{c}" for k in (0, 1) for c in ("q", "tax")]
                   + ["1e-9 * greatest(var_pop(q), var_pop(tax)) AS eps", "avg(disc) AS mx", "avg(label) AS my",
                      f"covar_pop(disc, label) * count(*) / (var_pop(disc) * count(*) + {_STACK_ALPHA}) AS w"])

_STACK_SQL = f"""WITH m AS MATERIALIZED (SELECT *, ('0x' || substr(md5('moments:' || rid), 1, 4))::INTEGER % {FOLDS} AS fold,
  {hdigit_sql('rid', 'stack')} < 'c' AS train FROM ({MODEL_FRAME_SQL})),
s AS MATERIALIZED (SELECT h.fold, {_FIRST} FROM (SELECT DISTINCT fold FROM m WHERE train) h JOIN m ON m.fold <> h.fold AND m.train GROUP BY h.fold),
oof AS MATERIALIZED (SELECT r.rid, r.label, {_nb_p('s')} AS nb, s.my + s.w * (r.disc - s.mx) AS rg FROM m r JOIN s ON s.fold = r.fold WHERE r.train),
g AS (SELECT count(*) AS n, avg(nb) AS m1, avg(rg) AS m2, avg(label) AS my, var_pop(nb) * count(*) + {_META_ALPHA} AS a,
  covar_pop(nb, rg) * count(*) AS b, var_pop(rg) * count(*) + {_META_ALPHA} AS c, covar_pop(nb, label) * count(*) AS u, covar_pop(rg, label) * count(*) AS v FROM oof),
w AS (SELECT *, (u * c - v * b) / (a * c - b * b) AS w1, (v * a - u * b) / (a * c - b * b) AS w2 FROM g),
t AS MATERIALIZED (SELECT {_FIRST} FROM m WHERE train),
final AS (SELECT r.rid, {_nb_p('t')} AS nb, t.my + t.w * (r.disc - t.mx) AS rg FROM m r CROSS JOIN t WHERE NOT r.train)
SELECT f.rid, round(f.nb, 6) AS nb, round(f.rg, 6) AS rg, round(w.my + w.w1 * (f.nb - w.m1) + w.w2 * (f.rg - w.m2), 6) AS prediction FROM final f CROSS JOIN w"""


@query("stacked_nb_ridge", _STACK_SQL)
def stacked_nb_ridge(spark, d):
    """Naive Bayes and ridge, a ridge on their out-of-fold predictions; scored on rows outside the training set."""
    m = _folded(spark, d)
    is_train = hdigit("rid", "stack") < "c"
    fits = {"nb": lambda df: bayes.fit_gaussian_nb(df, ["q", "tax"]),
            "rg": lambda df: moments.fit_moments(df, ["disc"], "label", "ridge", alpha=_STACK_ALPHA)}
    model, _ = stacking.fit_stack(m.where(is_train), fits, lambda t: moments.fit_moments(t, ["nb", "rg"], "label", "ridge", alpha=_META_ALPHA),
                                  tasks={"rg": "regression"})
    return round_doubles(model.transform(m.where(~is_train).drop("fold")).select("rid", "nb", "rg", "prediction"))
