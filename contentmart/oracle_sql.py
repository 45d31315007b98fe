"""Helpers that spell the warehouse rules as DuckDB SQL (the oracle side).

The oracle must be a query, not DML, so a MERGE is spelt as a SELECT over a
FULL OUTER JOIN with side markers (``__t``/``__s`` = true), never key-is-NULL
tests: a NULL source key therefore stays "not matched".
"""

from __future__ import annotations


def date_key_sql(x: str) -> str:
    return f"cast(strftime({x}, '%Y%m%d') as bigint)"


def merge_sql(
    target_sql: str,
    source_sql: str,
    target_key: str,
    source_key: str,
    target_cols: list[tuple[str, str]],
    source_cols: list[str],
    matched: list[tuple[str, str | None, dict[str, str]]],
    not_matched: list[tuple[str, str | None, dict[str, str]]],
    output: str = "rows",
) -> str:
    """SELECT form of MERGE.

    ``target_cols``: (name, sql type).  Conditions and values reference
    ``t_<col>`` and ``s_<col>``.  ``output`` is ``rows`` (new target content),
    ``actions`` (rows per branch) or ``frame`` (rows with ``merge_action``).
    """
    t_sel = ", ".join(f"__T.{c} as t_{c}" for c, _ in target_cols)
    s_sel = ", ".join(f"__S.{c} as s_{c}" for c in source_cols)
    m_parts = []
    for i, (kind, cond, _) in enumerate(matched):
        label = "delete" if kind == "delete" else f"update:{i}"
        m_parts.append(f"when coalesce({cond or 'true'}, false) then '{label}'")
    n_parts = []
    for i, (_, cond, _) in enumerate(not_matched):
        n_parts.append(f"when coalesce({cond or 'true'}, false) then 'insert:{i}'")
    m_case = f"case {' '.join(m_parts)} else 'keep' end" if m_parts else "'keep'"
    n_case = f"case {' '.join(n_parts)} else 'skip' end" if n_parts else "'skip'"
    cols = []
    for c, typ in target_cols:
        whens = []
        for i, (kind, _, values) in enumerate(matched):
            if kind == "update" and c in values:
                whens.append(f"when merge_action = 'update:{i}' then {values[c]}")
        for i, (_, _, values) in enumerate(not_matched):
            whens.append(f"when merge_action = 'insert:{i}' then {values.get(c, 'null')}")
        expr = f"case {' '.join(whens)} else t_{c} end" if whens else f"t_{c}"
        cols.append(f"cast({expr} as {typ}) as {c}")
    body = f"""
__T as (select *, true as __t from ({target_sql}) x),
__S as (select *, true as __s from ({source_sql}) y),
__J as (select {t_sel}, {s_sel}, __T.__t as __t, __S.__s as __s
        from __T full outer join __S on __T.{target_key} = __S.{source_key}),
__A as (select *, case when __t and __s then {m_case} when __t then 'keep' else {n_case} end as merge_action from __J)"""
    if output == "actions":
        return f"with {body.strip()}\nselect split_part(merge_action, ':', 1) as merge_action, count(*) as rows from __A group by 1"
    select = ", ".join(cols)
    if output == "frame":
        return f"with {body.strip()}\nselect {select}, split_part(merge_action, ':', 1) as merge_action from __A"
    return f"with {body.strip()}\nselect {select} from __A where split_part(merge_action, ':', 1) in ('keep', 'update', 'insert')"
