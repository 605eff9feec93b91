"""Reusable CTE fragments for the DuckDB oracle queries (same formulas as ``plans.data``)."""

from __future__ import annotations

EMB = ("emb AS (SELECT vec_id AS row_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS j, "
       "CAST(unnest(embedding) AS DOUBLE) AS x, label FROM embeddings)")

LI_VEC = "[l_quantity / 50.0, l_extendedprice / 100000.0, l_discount * 10.0, l_tax * 10.0]"

LI = f"li AS (SELECT l_orderkey, l_linenumber, {LI_VEC} AS vec FROM lineitem)"

LIC = ("lic AS (SELECT l_orderkey, l_linenumber, CAST(generate_subscripts(vec, 1) - 1 AS INTEGER) AS j, "
       "unnest(vec) AS x FROM li)")


def weights(name: str, k: int, n: int, salt: int = 0) -> str:
    return (f"{name} AS (SELECT CAST(k AS INTEGER) AS k, CAST(j AS INTEGER) AS j, "
            f"((k*37 + j*17 + {salt}) % 101 - 50) / 500.0 AS w FROM range(0, {k}) a(k), range(0, {n}) b(j))")


def bias(name: str, n: int) -> str:
    return f"{name} AS (SELECT CAST(j AS INTEGER) AS j, ((j*13) % 7 - 3) / 10.0 AS b FROM range(0, {n}) t(j))"


def w_expr(k: int, j: int, salt: int = 0) -> str:
    return f"(({k}*37 + {j}*17 + {salt}) % 101 - 50) / 500.0"


def b_expr(j: int) -> str:
    return f"(({j}*13) % 7 - 3) / 10.0"


def r(expr: str, digits: int = 6) -> str:
    scale = f"{10 ** digits}.0"
    return f"round(({expr}) * {scale}) / {scale} + 0.0"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
