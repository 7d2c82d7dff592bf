"""Deterministic stand-ins for random draws, computed from a row id.

``rand()`` depends on how rows are partitioned and changes when a task is retried. These depend
on the id alone, so a lost partition is recomputed with the same values and another engine can
check them. Both functions give SQL text over a BIGINT column ``id``.
"""

from __future__ import annotations

# A prime below 2**31: products of two residues stay within BIGINT.
MODULUS = 2147483647

# Fixed values, one triple per independent draw: (factor, factor of the id's high part, offset).
STREAMS = [
    (1103515245, 48271, 12345),
    (214013, 69621, 2531011),
    (1664525, 16807, 1013904223),
    (22695477, 39373, 7919),
    (134775813, 40692, 104729),
    (69069, 40014, 3571),
    (1566083941, 62089911, 15013),
    (742938285, 45742, 611953),
]

# A base64 digest has letters, digits and two signs; the last two kinds map here.
_SIGNS = "0123456789+/"
_SIGN_LETTERS = "bdfhjlnprtvx"
_DIGEST_LETTERS = 22


def uniform_int(low: int, high: int, stream: int) -> str:
    """An evenly spread BIGINT in [low, high]. The id must not be negative.

    A linear map of the id modulo a prime, squared and mapped again, then scaled by its high end.
    """
    factor, high_factor, offset = STREAMS[stream]
    first = f"((id % {MODULUS} * {factor}L + id div {MODULUS} * {high_factor}L + {offset}) % {MODULUS})"
    second = f"({first} * {first} % {MODULUS} * {factor}L + {first}) % {MODULUS}"
    return f"({low}L + ({second}) * {high - low + 1}L div {MODULUS})"


def letters(shortest: int, longest: int, stream: int) -> str:
    """Lowercase text of ``shortest`` to ``longest`` letters."""
    digests = ", ".join(
        f"substring(base64(unhex(md5(concat('{stream}/{part}/', id)))), 1, {_DIGEST_LETTERS})"
        for part in range(-(-longest // _DIGEST_LETTERS))
    )
    text = f"translate(lower(concat({digests})), '{_SIGNS}', '{_SIGN_LETTERS}')"
    return f"substring({text}, 1, cast({uniform_int(shortest, longest, stream)} as int))"
