"""Words of letters and digits, as several operators take them."""

from __future__ import annotations

#: Bytes of a word stay, A-Z in lower case; every other ASCII byte becomes a space.
_WORD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cases A-Z and takes runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``; NULL has none."""
    return text.encode().translate(_WORD).split() if text else []
