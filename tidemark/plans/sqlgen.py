"""SQL text for the DuckDB oracle of composite queries (test oracle only).

These helpers spell out, as plain SQL, the same semantics that the Spark operators
implement, so that a reviewer can read the expected behaviour side by side.
"""

from __future__ import annotations

from collections.abc import Sequence


def trim_string(expr: str) -> str:
    # DuckDB regexp_replace needs the 'g' flag to replace every run
    return f"trim(regexp_replace({expr}, ' +', ' ', 'g'))"


def pad_left(expr: str, width: int) -> str:
    """Zero-padded to `width`; longer texts stay whole (DuckDB's lpad cuts them)."""
    x = f"CAST({expr} AS VARCHAR)"
    return f"repeat('0', greatest(0, {width} - length({x}))) || {x}"


def md5_concat(cols: Sequence[str], sep: str, null_token: str = "") -> str:
    parts = [f"coalesce(CAST({c} AS VARCHAR), '{null_token}')" for c in cols]
    glue = f" || '{sep}' || " if sep else " || "
    return f"md5({glue.join(parts)})"


def upsert(target: str, source: str, cols: Sequence[str], key: str, no_update: Sequence[str],
           gate: str | None = "HASH_CHANGE", op_col: str = "OPERATION_TYPE") -> str:
    """SELECT body of a hash-gated upsert (target FULL OUTER JOIN source on key)."""
    upd_cols = [c for c in cols if c not in set(no_update) | {op_col, key}]
    matched = "(t._t AND s._s)"
    cond = matched if gate is None else f"({matched} AND coalesce(t.{gate} <> s.{gate}, false))"
    sel = []
    for c in cols:
        if c == op_col:
            new = f"CASE WHEN s.{c} = 'DELETE' THEN 'DELETE' ELSE 'UPDATE' END"
        elif c in upd_cols:
            new = f"s.{c}"
        else:
            new = f"t.{c}"
        sel.append(f"CASE WHEN t._t IS NULL THEN s.{c} WHEN {cond} THEN {new} ELSE t.{c} END AS {c}")
    sel.append(f"CASE WHEN t._t IS NULL THEN 'insert' WHEN {cond} THEN 'update' ELSE 'unchanged' END AS MERGE_ACTION")
    return (f"SELECT {', '.join(sel)}\nFROM (SELECT *, true AS _t FROM {target}) t "
            f"FULL OUTER JOIN (SELECT *, true AS _s FROM {source}) s ON t.{key} = s.{key}")
