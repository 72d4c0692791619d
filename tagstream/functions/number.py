"""Numbers as the table stores them.

As SQL text, because a table may have thousands of columns: handing over one list of
texts is far quicker than building each column from Python, batch after batch.
"""

from __future__ import annotations

from tagstream.constants import NUMBER_LIMIT, NUMBER_SCALE


def clamped(number: str) -> str:
    """Within the column's range; NULL for NaN and the infinities, which texts can cast to."""
    limit = f"{NUMBER_LIMIT}D"
    return (
        f"CASE WHEN abs({number}) < double('infinity') "
        f"THEN greatest(least({number}, {limit}), -{limit}) END"
    )


def rounded(number: str) -> str:
    """To the column's three decimals.

    A number that already has at most three decimals is its own nearest multiple
    of a thousandth, and skips the decimal arithmetic of ``round``.
    """
    unit = f"{10.0**NUMBER_SCALE}D"
    return (
        f"CASE WHEN {number} = rint({number} * {unit}) / {unit} THEN {number} "
        f"ELSE round({number}, {NUMBER_SCALE}) END"
    )
