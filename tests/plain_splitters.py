"""The splitting rules, one text and one piece at a time, to hold the column expressions against."""

from collections.abc import Sequence


def merge_pieces(pieces: Sequence[str], joiner: str, size: int, overlap: int) -> list[str]:
    """Pack pieces up to `size`, then start again with the trailing pieces that fit in `overlap`."""
    chunks: list[str] = []
    held: list[str] = []
    held_len = 0
    gap = len(joiner)
    for piece in pieces:
        extra = len(piece) + (gap if held else 0)
        if held and held_len + extra > size:
            chunks.append(joiner.join(held).strip())
            while held and (held_len > overlap or held_len + len(piece) + gap > size):
                held_len -= len(held[0]) + (gap if len(held) > 1 else 0)
                held = held[1:]
            extra = len(piece) + (gap if held else 0)
        held.append(piece)
        held_len += extra
    chunks.append(joiner.join(held).strip())
    return [c for c in chunks if c]


def _cut_before(text: str, sep: str) -> list[str]:
    if sep == "":
        return list(text)
    first, *rest = text.split(sep)
    return [p for p in [first, *(sep + r for r in rest)] if p]


def split_recursive(text: str, separators: Sequence[str], size: int, overlap: int) -> list[str]:
    """Cut at the first separator found; pieces over `size` are cut again with the later ones."""
    at = next((i for i, s in enumerate(separators) if s == "" or s in text), len(separators) - 1)
    later = separators[at + 1:]
    out: list[str] = []
    short: list[str] = []
    for piece in _cut_before(text, separators[at]):
        if len(piece) <= size:
            short.append(piece)
            continue
        out += merge_pieces(short, "", size, overlap)
        short = []
        out += split_recursive(piece, later, size, overlap) if later else [piece]
    return out + merge_pieces(short, "", size, overlap)
