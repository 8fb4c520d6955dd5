"""Small SQL fragments shared by the oracle queries (DuckDB dialect)."""

from __future__ import annotations

from marginflow.oracle.roles_sql import commercial_month_sql, local_date_sql, sround  # noqa: F401


def nz(x: str) -> str:
    return f"coalesce({x}, 0.0)"


def discount_factor(*ds: str) -> str:
    out = "1.0"
    for d in ds:
        out = f"({out} * (1.0 - {nz(d)} / 100.0))"
    return out


def business_unit(co: str, br: str) -> str:
    return (f"(CASE WHEN {co} = '0001' AND {br} = '0001' THEN 'A Agency' "
            f"WHEN {co} IN ('0001', '0003') THEN 'A' ELSE 'B' END)")


def fiscal_flag(co: str) -> str:
    return f"(CASE WHEN {co} IN ('0001', '0002') THEN 'Fiscal' ELSE 'Non-fiscal' END)"


def document_number(kind: str, code: str, num: str) -> str:
    return (f"(CASE WHEN {code} IS NOT NULL AND {code} <> '' THEN concat_ws('-', coalesce(CAST({kind} AS VARCHAR), 'None'), "
            f"{code}, coalesce(CAST({num} AS VARCHAR), 'None')) END)")


def tax_net(p: str, t: str) -> str:
    return f"({p} / (1.0 + {t} / 100.0))"


def tax_gross(p: str, t: str) -> str:
    return f"({p} * (1.0 + {t} / 100.0))"


def share(amount: str, weight: str, total: str) -> str:
    return f"(CASE WHEN {total} > 0 THEN {amount} * ({weight} / {total}) ELSE 0.0 END)"


def try_double(x: str) -> str:
    return f"TRY_CAST({x} AS DOUBLE)"


def xsum(x: str) -> str:
    """Exact sum (decimal) returned as double — mirrors ``exact_sum``."""
    return f"CAST(sum(CAST({x} AS DECIMAL(38,6))) AS DOUBLE)"


def xavg(x: str) -> str:
    return f"({xsum(x)} / count({x}))"
