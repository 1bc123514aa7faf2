"""Terms of a text: runs of digits, letters and whatever lies beyond ASCII, A-Z in lower case."""

from __future__ import annotations

#: Every byte of UTF-8 as it counts in a term; all that ends one becomes a space.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
                    for b in range(256))


def terms(text: str) -> list[bytes]:
    """The terms of a text in order, in UTF-8."""
    return text.encode().translate(_TERM_BYTES).split()
