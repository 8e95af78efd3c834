"""Labels, bands and colours."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from velorisk import constants as C


def _pick(value: Column, choices: dict, default) -> Column:
    """``CASE value WHEN … ELSE default END``; a null value takes the default."""
    expression = None
    for key, result in choices.items():
        if expression is None:
            expression = F.when(value == F.lit(key), F.lit(result))
        else:
            expression = expression.when(value == F.lit(key), F.lit(result))
    return expression.otherwise(F.lit(default))


def period_of_day(hour: Column) -> Column:
    expression = F.when(F.lit(False), F.lit(None).cast("string"))
    for name, first, last in C.PERIODS:
        expression = expression.when(hour.between(first, last), F.lit(name))
    return expression.otherwise(F.lit("Unknown"))


def period_position(period: Column) -> Column:
    """Place of a period in the fixed report order; unknown ones come last."""
    order = {name: place for place, (name, _, _) in enumerate(C.PERIODS, start=1)}
    return _pick(period, order, len(order) + 1).cast("bigint")


def severity_label(severity: Column) -> Column:
    return _pick(severity, {1: "Fatal", 2: "Serious"}, "Slight")


def severity_weight(severity: Column) -> Column:
    """Staging weight: anything but fatal or serious, null included, weighs 1."""
    return _pick(severity, {1: 10, 2: 3}, 1).cast("bigint")


def scoring_weight(severity: Column) -> Column:
    """Weight in risk scores: an unknown severity weighs nothing."""
    return _pick(severity, C.SEVERITY_WEIGHTS, 0).cast("bigint")


def weekday_name(day_of_week: Column) -> Column:
    return _pick(day_of_week, C.WEEKDAYS, "Unknown")


def day_type(day_of_week: Column) -> Column:
    return F.when(day_of_week.isin(1, 7), F.lit("Weekend")).otherwise(F.lit("Weekday"))


def decile_colour(decile: Column) -> Column:
    return _pick(decile, C.DECILE_COLOURS, C.LOWEST_DECILE_COLOUR)


def is_blackspot(decile: Column) -> Column:
    return decile == F.lit(10)


def risk_category(score: Column, thresholds: dict[float, Column]) -> Column:
    """Band of a score; a score equal to a threshold stays in the band below."""
    expression = F.when(F.lit(False), F.lit(None).cast("string"))
    for name, quantile, *_ in C.RISK_CATEGORIES:
        expression = expression.when(score > thresholds[quantile], F.lit(name))
    return expression.otherwise(F.lit(C.LOWEST_CATEGORY[0]))


def category_colour(category: Column) -> Column:
    return _pick(category, {c[0]: c[2] for c in C.RISK_CATEGORIES}, C.LOWEST_CATEGORY[1])


def line_weight(category: Column) -> Column:
    known = {c[0]: c[3] for c in C.RISK_CATEGORIES} | {C.LOWEST_CATEGORY[0]: C.LOWEST_CATEGORY[2]}
    return _pick(category, known, C.DEFAULT_LINE_WEIGHT).cast("bigint")


def line_opacity(category: Column) -> Column:
    known = {c[0]: c[4] for c in C.RISK_CATEGORIES} | {C.LOWEST_CATEGORY[0]: C.LOWEST_CATEGORY[3]}
    return _pick(category, known, C.DEFAULT_LINE_OPACITY)


def corridor_label(name_a: Column, name_b: Column) -> Column:
    return F.concat(name_a, F.lit(" ↔ "), name_b)


def title_label(column_name: str) -> str:
    """Heading of a column in a popup: ``risk_decile`` reads ``Risk Decile``."""
    return column_name.replace("_", " ").title()
