import datetime as dt
from decimal import Decimal


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def dec(s: str) -> Decimal:
    return Decimal(s)


def rows(df, *cols):
    """Sorted list of tuples of the given columns (all columns if none given)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()),
                  key=lambda t: tuple((x is None, str(x)) for x in t))


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    """Executed (final, after AQE) physical plan text; run the query first."""
    return strip_initial_plans(plan_text(df))


def exchanges(df) -> int:
    df.collect()
    return final_plan(df).count("Exchange hashpartitioning")


def strip_initial_plans(text: str) -> str:
    """Drop every ``== Initial Plan ==`` subtree of an AQE plan string (the
    main plan's and those of subqueries), keeping all final plans."""
    out, skip_at = [], None
    for line in text.splitlines():
        content = len(line) - len(line.lstrip(" :|+-"))
        if skip_at is not None:
            if content > skip_at:
                continue
            skip_at = None
        if "== Initial Plan ==" in line:
            skip_at = len(line) - len(line.lstrip(" :|"))   # column of the marker's "+-"
            continue
        out.append(line)
    return "\n".join(out)
