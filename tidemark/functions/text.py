"""Splitting of texts and small text columns, all as column expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: separators by language, tried in this order
SEPARATORS: dict[str, list[str]] = {
    "cpp": ["\nclass ", "\nvoid ", "\nint ", "\nfloat ", "\ndouble ", "\nif ", "\nfor ", "\nwhile ", "\nswitch ",
            "\ncase ", "\n\n", "\n", " ", ""],
    "go": ["\nfunc ", "\nvar ", "\nconst ", "\ntype ", "\nif ", "\nfor ", "\nswitch ", "\ncase ", "\n\n", "\n", " ", ""],
    "java": ["\nclass ", "\npublic ", "\nprotected ", "\nprivate ", "\nstatic ", "\nif ", "\nfor ", "\nwhile ",
             "\nswitch ", "\ncase ", "\n\n", "\n", " ", ""],
    "js": ["\nfunction ", "\nconst ", "\nlet ", "\nvar ", "\nclass ", "\nif ", "\nfor ", "\nwhile ", "\nswitch ",
           "\ncase ", "\ndefault ", "\n\n", "\n", " ", ""],
    "php": ["\nfunction ", "\nclass ", "\nif ", "\nforeach ", "\nwhile ", "\ndo ", "\nswitch ", "\ncase ", "\n\n", "\n",
            " ", ""],
    "proto": ["\nmessage ", "\nservice ", "\nenum ", "\noption ", "\nimport ", "\nsyntax ", "\n\n", "\n", " ", ""],
    "python": ["\nclass ", "\ndef ", "\n\tdef ", "\n\n", "\n", " ", ""],
    "rst": ["\n===\n", "\n---\n", "\n***\n", "\n.. ", "\n\n", "\n", " ", ""],
    "ruby": ["\ndef ", "\nclass ", "\nif ", "\nunless ", "\nwhile ", "\nfor ", "\ndo ", "\nbegin ", "\nrescue ", "\n\n",
             "\n", " ", ""],
    "rust": ["\nfn ", "\nconst ", "\nlet ", "\nif ", "\nwhile ", "\nfor ", "\nloop ", "\nmatch ", "\n\n", "\n", " ", ""],
    "scala": ["\nclass ", "\nobject ", "\ndef ", "\nval ", "\nvar ", "\nif ", "\nfor ", "\nwhile ", "\nmatch ", "\ncase ",
              "\n\n", "\n", " ", ""],
    "swift": ["\nfunc ", "\nclass ", "\nstruct ", "\nenum ", "\nif ", "\nfor ", "\nwhile ", "\ndo ", "\nswitch ",
              "\ncase ", "\n\n", "\n", " ", ""],
    "markdown": ["\n## ", "\n### ", "\n#### ", "\n##### ", "\n###### ", "```\n\n", "\n\n***\n\n", "\n\n---\n\n",
                 "\n\n___\n\n", "\n\n", "\n", " ", ""],
    "latex": ["\n\\chapter{", "\n\\section{", "\n\\subsection{", "\n\\subsubsection{", "\n\\begin{enumerate}",
              "\n\\begin{itemize}", "\n\\begin{description}", "\n\\begin{list}", "\n\\begin{quote}",
              "\n\\begin{quotation}", "\n\\begin{verse}", "\n\\begin{verbatim}", "\n\\begin{align}", "$$", "$", "\n\n",
              "\n", " ", ""],
    "html": ["<body>", "<div>", "<p>", "<br>", "<li>", "<h1>", "<h2>", "<h3>", "<h4>", "<h5>", "<h6>", "<span>",
             "<table>", "<tr>", "<td>", "<th>", "<ul>", "<ol>", "<header>", "<footer>", "<nav>", "<head>", "<style>",
             "<script>", "<meta>", "<title>", " ", ""],
    "sol": ["\npragma ", "\nusing ", "\ncontract ", "\ninterface ", "\nlibrary ", "\nconstructor ", "\ntype ",
            "\nfunction ", "\nevent ", "\nmodifier ", "\nerror ", "\nstruct ", "\nenum ", "\nif ", "\nfor ", "\nwhile ",
            "\ndo while ", "\nassembly ", "\n\n", "\n", " ", ""],
}
PLAIN = ["\n\n", "\n", " ", ""]


# fixed values: every character that counts as white space
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def stripped(text: Column) -> Column:
    """Strip all white space at both ends."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once and use it several times in `body`."""
    return F.element_at(F.transform(F.array(value), body), 1)


def no_bad_images(text: Column) -> Column:
    """Drop Markdown images whose address is not http(s)."""
    return F.regexp_replace(text, r"!\[[^\]]*\]\((?!https?://)[^)]*\)", "")


def utf16_length(text: Column) -> Column:
    return F.length(text) + F.regexp_count(text, F.lit(r"[\x{10000}-\x{10FFFF}]"))


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), 0)


# fixed values: escape sequence and the word that stands for it in stored text
ESCAPE_WORDS = (
    ('"', "DOUBLE_QUOTE"),
    ("\n", "NEWLINE"),
    ("\b", "BACKSPACE"),
    ("\f", "FORM_FEED"),
    ("\r", "CARRIAGE_RETURN"),
    ("\t", "TAB"),
    ("\\", "BACKSLASH"),
)


def escape_words(text: Column, prefix: str, reverse: bool = False) -> Column:
    """Swap control characters for `prefix + word`, or back again."""
    for char, word in ESCAPE_WORDS:
        a, b = (prefix + word, char) if reverse else (char, prefix + word)
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


# ---- splitters: pieces are packed by a fold over their lengths, so a text is walked once per separator

_CUTS = "array<struct<lo:int,hi:int,big:boolean>>"


def _check(size: int, overlap: int) -> None:
    if overlap > size:
        raise ValueError("overlap must not exceed the chunk size")


def _pieces(text: Column, separator: str, keep: bool) -> Column:
    """The non-empty parts between separators; with `keep`, each but the first begins with its separator."""
    parts = F.split(text, f"\\Q{separator}\\E", -1)
    if keep:
        parts = F.transform(parts, lambda part, i: F.when(i == 0, part).otherwise(F.concat(F.lit(separator), part)))
    return F.filter(parts, lambda part: part != "")


def _cuts(pieces: Column, gap: int, size: int, overlap: int, alone: bool) -> Column:
    """Ranges (lo, hi, big) of pieces that make one chunk of up to `size`, pieces joined by `gap` characters.

    A chunk begins with the last pieces of the one before that fit in `overlap`.  With `alone`, a piece
    over `size` is a range of its own, marked `big`, and nothing is carried over it.  The state holds the
    starts of the pieces of the open chunk only.
    """

    def cut(lo: Column, hi: Column, big: bool) -> Column:
        return F.struct(lo.cast("int").alias("lo"), hi.cast("int").alias("hi"), F.lit(big).alias("big"))

    def add(state: Column, length: Column) -> Column:
        at, n, held, cuts = state["at"], state["n"], state["held"], state["cuts"]
        big = (length > size) if alone else F.lit(False)
        full = (F.size(held) > 0) & (at + length - held[0] > size)
        carried = F.filter(held, lambda p: (at - p - gap <= overlap) & (at + length - p <= size))
        held_now = F.when(full, F.array_append(carried, at)).otherwise(F.array_append(held, at))
        cuts_now = F.when(full, F.array_append(cuts, cut(n - F.size(held), n, False))).otherwise(cuts)
        if alone:
            held_now = F.when(big, F.slice(held, 1, 0)).otherwise(held_now)
            cuts_now = F.when(big, F.array_append(cuts_now, cut(n, n + 1, True))).otherwise(cuts_now)
        return F.struct((at + length + gap).alias("at"), (n + 1).alias("n"), held_now.alias("held"), cuts_now.alias("cuts"))

    def close(state: Column) -> Column:
        n, held, cuts = state["n"], state["held"], state["cuts"]
        return F.when(F.size(held) > 0, F.array_append(cuts, cut(n - F.size(held), n, False))).otherwise(cuts)

    empty = F.struct(
        F.lit(0).alias("at"), F.lit(0).alias("n"), F.array().cast("array<int>").alias("held"), F.array().cast(_CUTS).alias("cuts"))
    return F.aggregate(F.transform(pieces, F.length), empty, add, close)


def _windows(text: Column, size: int, overlap: int) -> Column:
    """Pieces of one character need no fold: every chunk starts `size - overlap` after the one before."""
    step = max(1, size - overlap)
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil((F.length(text) - size) / F.lit(step))).cast("int"))
    return F.when(text.isNotNull(), let(F.split(text, "", -1), lambda letters: F.transform(
        starts, lambda i: stripped(F.array_join(F.slice(letters, i * step + 1, F.lit(size)), "")))))


def _joined(pieces: Column, cut: Column, joiner: str) -> Column:
    return stripped(F.array_join(F.slice(pieces, cut["lo"] + 1, cut["hi"] - cut["lo"]), joiner))


def separator_chunks(text: Column, separator: str, size: int, overlap: int) -> Column:
    """Parts between separators, joined again up to `size`; a part over `size` is a chunk.  Null for a null text."""
    _check(size, overlap)
    if separator:
        chunks = let(_pieces(text, separator, keep=False), lambda pieces: F.transform(
            _cuts(pieces, len(separator), size, overlap, alone=False), lambda cut: _joined(pieces, cut, separator)))
    else:
        chunks = _windows(text, size, overlap)
    return F.filter(chunks, lambda chunk: chunk != "")


def with_recursive_chunks(
    df: DataFrame, out: str, text: Column, separators: Sequence[str], size: int, overlap: int
) -> DataFrame:
    """Add the array `out` of chunks, one step per separator: what fits is packed, pieces over `size` go on to the next one.

    Pieces that no separator makes small enough stay as they are.  Null for a null text.  Every step
    is analysed by itself and names the one before it once, so that a language with many separators stays plannable.
    """
    _check(size, overlap)

    def part(body: Column, done: Column) -> Column:
        return F.struct(body.alias("text"), done.alias("done"))

    def cut(body: Column, separator: str) -> Column:
        if not separator:
            return F.transform(_windows(body, size, overlap), lambda chunk: part(chunk, F.lit(True)))
        return let(_pieces(body, separator, keep=True), lambda pieces: F.transform(
            _cuts(pieces, 0, size, overlap, alone=True),
            lambda c: part(F.when(c["big"], pieces[c["lo"]]).otherwise(_joined(pieces, c, "")), ~c["big"])))

    df = df.withColumn(out, F.when(text.isNotNull(), F.array(part(text, F.lit(False)))))
    for separator in separators:
        df = df.withColumn(out, F.flatten(F.transform(
            out, lambda p: F.when(p["done"], F.array(p)).otherwise(cut(p["text"], separator)))))  # noqa: B023
    return df.withColumn(out, F.transform(F.filter(out, lambda p: p["text"] != ""), lambda p: p["text"]))
