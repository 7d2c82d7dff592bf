"""Age bands, as SQL text."""

from __future__ import annotations

# Fixed values: (lowest age, first age above, label); the last band includes its upper bound.
AGE_BANDS = [
    (10, 20, "[10,20)"),
    (20, 30, "[20,30)"),
    (30, 40, "[30,40)"),
    (40, 50, "[40,50)"),
    (50, 60, "[50,60)"),
    (60, 71, "[60,70]"),
]


def age_band(age: str, other: str = "UNKNOWN") -> str:
    """Label of the band an integer age falls in, ``other`` outside all bands, null for null."""
    bands = " ".join(
        f"when {age} >= {low} and {age} < {above} then '{name}'" for low, above, name in AGE_BANDS
    )
    return f"case when {age} is null then null {bands} else '{other}' end"
