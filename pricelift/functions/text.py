"""Explanation texts, and the reading of explanation replies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import ColumnLike, col

# The words an explanation falls back to.
UNAVAILABLE = "Unavailable"
RULE_REASONING = "Rule-based summary; no analyst explanation was available."
NO_REASONING = "No specific reasoning was returned."
UNPARSED_REASONING = "The reply could not be read as structured data."


def money_text(value: ColumnLike) -> Column:
    """Two decimals without thousands separators."""
    return F.format_string("%.2f", F.round(col(value), 2))


def rule_sentence(change_pct: ColumnLike, uplift: ColumnLike, price: ColumnLike) -> Column:
    """What to do with the price and why, in one line: new price, signed change, and the aim.

    A row without an uplift is an expiry markdown, whose aim is to clear stock."""
    move = F.format_string("%+.1f%%", F.coalesce(col(change_pct), F.lit(0.0)))
    aim = F.when(col(uplift).isNull(), F.lit("clears stock ahead of its expiry date")).otherwise(
        F.concat(F.lit("adds an estimated $"), money_text(uplift), F.lit(" a week"))
    )
    return F.concat(F.lit("New price $"), money_text(price), F.lit(" ("), move, F.lit("): "), aim, F.lit("."))


def prompt_text(
    name: ColumnLike, department: ColumnLike, current: ColumnLike, recommended: ColumnLike,
    change_pct: ColumnLike, sensitivity: ColumnLike, urgency: ColumnLike, uplift: ColumnLike,
) -> Column:
    """Request for an explanation of one price, built from eight signals."""
    change = F.coalesce(col(change_pct), F.lit(0.0))
    lines = [
        F.lit("Explain this retail price to a manager. Answer only with JSON holding explanation,"
              " confidence_label (High, Medium or Low), confidence_pct (0-100) and reasoning."),
        F.concat(F.lit("product="), F.coalesce(col(name), F.lit("Unknown"))),
        F.concat(F.lit("department="), F.coalesce(col(department), F.lit("General"))),
        F.concat(F.lit("current=$"), money_text(F.coalesce(col(current), F.lit(0.0)))),
        F.concat(F.lit("recommended=$"), money_text(F.coalesce(col(recommended), F.lit(0.0)))),
        F.concat(F.lit("change="), F.format_string("%+.1f", change), F.lit("%")),
        F.concat(F.lit("sensitivity="), F.coalesce(col(sensitivity), F.lit("Medium"))),
        F.concat(F.lit("stock="), F.coalesce(col(urgency), F.lit("Normal"))),
        F.when(col(uplift).isNull(), F.lit("uplift=not comparable, expiry markdown")).otherwise(
            F.concat(F.lit("uplift=$"), money_text(uplift))
        ),
    ]
    return F.concat_ws("\n", *lines)


def stripped(text: ColumnLike) -> Column:
    """Without white space at both ends (``trim`` only removes blanks)."""
    return F.regexp_replace(col(text), r"^\s+|\s+$", "")


def json_object(text: ColumnLike) -> Column:
    """The text from the first ``{`` to the last ``}`` of a reply; null where there is no such stretch.

    An array is no object: a reply whose first bracket is ``[`` gives null."""
    reply = col(text)
    first, last = F.instr(reply, "{"), F.length(reply) - F.instr(F.reverse(reply), "}") + 1
    array = F.instr(reply, "[")
    return F.when((first > 0) & (last > first) & ((array == 0) | (array > first)), F.substr(reply, first, last - first + 1))
