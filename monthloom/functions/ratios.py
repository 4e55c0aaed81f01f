"""Exact guarded ratios. Missing is never zero, and a ratio needs a positive base."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# decimal(29,9) operands make Spark's quotient decimal(38,9), rounded half up.
OPERAND = "decimal(29,9)"
NANO = 1_000_000_000
# Below this, operands, and a quotient on its way through decimal(29,9), fit in 20 whole digits.
NARROW = 10**20


def _scaled(value: Column) -> Column:
    """A non-negative decimal(38,9) times 1e9 as decimal(38,0), exactly."""
    nano = F.lit(NANO).cast("decimal(10,0)")
    whole = F.floor(value).cast("decimal(29,0)")
    rest = (value % F.lit(1).cast("decimal(1,0)")).cast("decimal(10,9)") * nano
    return (whole * nano).cast("decimal(38,0)") + rest.cast("decimal(10,0)")


def _magnitude(value: Column) -> Column:
    """Absolute value; Spark's own rounds to 34 digits."""
    return F.ltrim(value.cast("decimal(38,9)").cast("string"), F.lit("-")).cast("decimal(38,9)")


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once and not copied into the expression."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _exact_quotient(numerator: Column, denominator: Column, rounded: bool) -> Column:
    """Quotient of any two decimal(38,9) with nine digits, rounded half up or cut.

    Long division in two steps: whole part and remainder first, then the remainder by the
    denominator in units of 1e-9. Remainders are exact in Spark's types where a quotient of
    38-digit operands is not; a rounded quotient less its rounded fraction gives the whole
    part. Only a result beyond decimal(38,9) fails.
    """
    none = F.lit(0).cast("decimal(38,9)")

    def scaled(pair: Column) -> Column:
        return F.struct(
            pair["d"].alias("d"), _scaled(pair["n"]).alias("top"), _scaled(pair["d"]).alias("bottom")
        )

    def split(x: Column) -> Column:
        rest = (x["top"] % x["bottom"]).cast("decimal(38,0)")
        whole = F.round(x["top"] / x["bottom"] - rest / x["bottom"], 0).cast("decimal(29,0)")
        return F.struct(x["d"].alias("d"), x["bottom"].alias("bottom"), rest.alias("rest"), whole.alias("whole"))

    def digits(x: Column) -> Column:
        left = (x["rest"] % x["d"]).cast("decimal(38,9)")
        nanos = F.round(x["rest"] / x["d"] - left / x["d"], 0).cast("bigint")
        if rounded:
            odd = _scaled(left)
            nanos = nanos + F.when(odd >= x["bottom"] - odd, 1).otherwise(0)
        return F.struct(x["whole"].alias("whole"), nanos.alias("nanos"))

    def text(x: Column) -> Column:
        full = F.when(x["nanos"] >= NANO, 1).otherwise(0)
        whole = (x["whole"] + full.cast("decimal(1,0)")).cast("decimal(30,0)").cast("string")
        return F.concat(whole, F.lit("."), F.lpad((x["nanos"] - full * NANO).cast("string"), 9, "0"))

    pair = F.struct(
        _magnitude(numerator).alias("n"), F.nullif(_magnitude(denominator), none).alias("d")
    )
    found = _let(pair, lambda p: _let(scaled(p), lambda x: _let(split(x), lambda y: _let(digits(y), text))))
    sign = F.when((numerator < 0) != (denominator < 0), F.lit("-")).otherwise(F.lit(""))
    return F.concat(sign, found).cast("decimal(38,9)")


def _narrow(*values: Column) -> Column:
    fits, limit = F.lit(True), F.lit(str(NARROW)).cast("decimal(29,0)")
    for value in values:
        fits = fits & (value < limit) & (value > F.lit(f"-{NARROW}").cast("decimal(29,0)"))
    return fits


def _quick(numerator: Column, denominator: Column) -> Column:
    n, d = (x.try_cast(OPERAND) for x in (numerator, denominator))
    return F.try_divide(n, d).cast("decimal(38,9)")


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """NULL for a NULL or zero denominator; nine fractional digits, rounded half up.

    Narrow operands take one division; the result is the same either way.
    """
    exact = _exact_quotient(numerator, denominator, rounded=True)
    return F.when(_narrow(numerator, denominator), _quick(numerator, denominator)).otherwise(exact)


def positive_ratio(numerator: Column, denominator: Column) -> Column:
    return F.when(denominator > 0, safe_divide(numerator, denominator))


def _less_one(ratio: Column) -> Column:
    """A ratio minus one with all digits; a wide one is far from zero, so its fraction stays."""
    text = ratio.cast("string")
    whole = F.substring_index(text, ".", 1).cast("decimal(29,0)") - F.lit(1).cast("decimal(1,0)")
    wide = F.concat(whole.cast("string"), F.lit("."), F.substring_index(text, ".", -1))
    quick = (ratio.try_cast(OPERAND) - F.lit(1)).cast("decimal(38,9)")
    return F.when(_narrow(ratio), quick).otherwise(wide.cast("decimal(38,9)"))


def growth(current: Column, base: Column) -> Column:
    """Ratio minus one; above a base of one, narrow operands have a narrow ratio."""
    quick = (_quick(current, base).try_cast(OPERAND) - F.lit(1)).cast("decimal(38,9)")
    exact = _let(_exact_quotient(current, base, rounded=True), _less_one)
    return F.when((base >= 1) & _narrow(current, base), quick).when(base > 0, exact)


def unit_value(value: Column, weight: Column) -> Column:
    return positive_ratio(value, weight)


def _nano(value: Column) -> Column:
    scaled = value.try_cast(OPERAND) * F.lit(NANO).cast("decimal(10,0)")
    return scaled.cast("decimal(29,0)")


def trunc_share(numerator: Column, denominator: Column) -> Column:
    """Ratio cut (not rounded) at nine digits; used by the interactive layer.

    Spark's ``div`` yields a BIGINT: it serves while the quotient in units of 1e-9 surely is one.
    """
    limit = F.lit("1e9").cast("decimal(10,0)")
    simple = (denominator >= 1) & (numerator < limit) & (numerator > F.lit("-1e9").cast("decimal(10,0)"))
    top = (_nano(numerator) * F.lit(NANO).cast("decimal(10,0)")).cast("decimal(38,0)")
    quotient = F.call_function("div", top, _nano(denominator)).cast("decimal(19,0)")
    quick = (quotient * F.lit("0.000000001").cast("decimal(9,9)")).cast("decimal(38,9)")
    exact = _exact_quotient(numerator, denominator, rounded=False)
    return F.when(simple & _narrow(denominator), quick).when(denominator > 0, exact)


def trunc_growth(current: Column, base: Column) -> Column:
    return _let(trunc_share(current, base), _less_one)


def float_to_decimal(value: Column) -> Column:
    """Nine digits, half away from zero."""
    return value.cast("decimal(38,9)")


# The same ratios over a whole frame. They are SQL text in stages of plain columns: Spark
# compiles them, no expression is copied into another, and few calls reach the JVM.
KINDS = ("safe", "positive", "growth", "cut", "cut_growth")
_ONE, _NANO_SQL = "CAST(1 AS decimal(1,0))", f"CAST({NANO} AS decimal(10,0))"
_LIMIT = f"CAST('{NARROW}' AS decimal(29,0))"


def _narrow_sql(*values: str) -> str:
    return " AND ".join(f"{v} < {_LIMIT} AND {v} > -{_LIMIT}" for v in values)


def _operand(value: str) -> str:
    return f"try_cast({value} AS {OPERAND})"


def _scaled_sql(value: str) -> str:
    rest = f"CAST(CAST({value} % {_ONE} AS decimal(10,9)) * {_NANO_SQL} AS decimal(10,0))"
    return f"CAST(CAST(floor({value}) AS decimal(29,0)) * {_NANO_SQL} AS decimal(38,0)) + {rest}"


def _quick_sql(kind: str, n: str, d: str) -> tuple[str, str, str]:
    """Where a ratio is defined, where the quick formula serves, and that formula."""
    divided = f"CAST(try_divide({_operand(n)}, {_operand(d)}) AS decimal(38,9))"
    if kind == "safe":
        return f"{d} <> 0", _narrow_sql(n, d), divided
    if kind == "positive":
        return f"{d} > 0", _narrow_sql(n, d), divided
    if kind == "growth":
        return f"{d} > 0", f"{d} >= 1 AND {_narrow_sql(n, d)}", f"CAST({_operand(divided)} - 1 AS decimal(38,9))"
    nano = "CAST({} * {} AS decimal(29,0))".format
    top = f"CAST({nano(_operand(n), _NANO_SQL)} * {_NANO_SQL} AS decimal(38,0))"
    whole = f"CAST({top} div {nano(_operand(d), _NANO_SQL)} AS decimal(19,0))"
    cut = f"CAST({whole} * CAST(0.000000001 AS decimal(9,9)) AS decimal(38,9))"
    if kind == "cut_growth":
        cut = f"CAST({_operand(cut)} - 1 AS decimal(38,9))"
    simple = f"{d} >= 1 AND {n} < 1000000000 AND {n} > -1000000000 AND {_narrow_sql(d)}"
    return f"{d} > 0", simple, cut


def with_ratios(frame: DataFrame, wanted: Mapping[str, tuple[str, str, str]]) -> DataFrame:
    """``frame`` with a column per entry of ``wanted``: name -> (kind, numerator, denominator).

    Kinds: ``safe`` as ``safe_divide``, ``positive`` as ``positive_ratio``, ``growth`` as
    ``growth``, ``cut`` as ``trunc_share``, ``cut_growth`` as ``trunc_growth``. Numerator and
    denominator are names of decimal columns. Rows that the quick formula does not serve get
    the long division, all others leave its columns empty. A column of the frame with a wanted
    name is replaced.
    """
    stages: list[list[str]] = [[] for _ in range(8)]
    shown = []
    for place, (name, (kind, numerator, denominator)) in enumerate(wanted.items()):
        if kind not in KINDS:
            raise ValueError(f"unknown kind of ratio: {kind}")
        n, d = f"`{numerator}`", f"`{denominator}`"
        x = lambda part, place=place: f"__{part}{place}"
        defined, simple, quick = _quick_sql(kind, n, d)
        slow = f"{n} IS NOT NULL AND coalesce({defined}, false) AND NOT ({simple})"
        stages[0] += [f"{slow} AS {x('slow')}", f"CASE WHEN {defined} AND {simple} THEN {quick} END AS {x('quick')}"]
        stages[1] += [
            f"CASE WHEN {x('slow')} THEN CAST(ltrim('-', CAST(CAST({v} AS decimal(38,9)) AS string)) AS decimal(38,9)) END AS {x(part)}"
            for part, v in (("n", n), ("d", d))
        ]
        stages[2] += [f"{_scaled_sql(x(part))} AS {x(to)}" for part, to in (("n", "top"), ("d", "bottom"))]
        stages[3].append(f"CAST({x('top')} % {x('bottom')} AS decimal(38,0)) AS {x('rest')}")
        stages[4] += [
            f"CAST(round({x('top')} / {x('bottom')} - {x('rest')} / {x('bottom')}, 0) AS decimal(29,0)) AS {x('whole')}",
            f"CAST({x('rest')} % {x('d')} AS decimal(38,9)) AS {x('left')}",
        ]
        nanos = f"CAST(round({x('rest')} / {x('d')} - {x('left')} / {x('d')}, 0) AS bigint)"
        stages[5].append(f"{nanos} AS {x('digits')}")
        more = x("digits")
        if kind in ("safe", "positive", "growth"):
            stages[5].append(f"{_scaled_sql(x('left'))} AS {x('odd')}")
            more += f" + CASE WHEN {x('odd')} >= {x('bottom')} - {x('odd')} THEN 1 ELSE 0 END"
        stages[6].append(f"{more} AS {x('nanos')}")
        carry = f"CASE WHEN {x('nanos')} >= {NANO} THEN 1 ELSE 0 END"
        whole = f"CAST({x('whole')} + CAST({carry} AS decimal(1,0)) AS decimal(30,0))"
        sign = f"CASE WHEN ({n} < 0) <> ({d} < 0) THEN '-' ELSE '' END"
        fraction = f"lpad(CAST({x('nanos')} % {NANO} AS string), 9, '0')"
        stages[7].append(f"concat({sign}, CAST({whole} AS string), '.', {fraction}) AS {x('text')}")
        exact = f"CAST({x('text')} AS decimal(38,9))"
        if kind in ("growth", "cut_growth"):
            # Less one on the text keeps all digits of a wide ratio; a narrow one is subtracted.
            less = f"CAST(CAST(substring_index({x('text')}, '.', 1) AS decimal(29,0)) - {_ONE} AS string)"
            wide = f"CAST(concat({less}, '.', substring_index({x('text')}, '.', -1)) AS decimal(38,9))"
            exact = f"CASE WHEN length({x('text')}) <= 29 THEN CAST({_operand(exact)} - 1 AS decimal(38,9)) ELSE {wide} END"
        shown.append(f"'{name}', CASE WHEN {x('slow')} THEN {exact} ELSE {x('quick')} END")
    kept = [f"`{column}`" for column in frame.columns if column not in wanted]
    for stage in stages:
        frame = frame.selectExpr("*", *stage)
    # A filter on a ratio is not pushed below this: it would copy all stages into itself.
    return frame.selectExpr(*kept, f"inline(array(named_struct({', '.join(shown)})))")
