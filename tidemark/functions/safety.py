"""Text safety as columns: personal data, injection, links, deny lists, unsafe code.

Patterns use the Unicode flag so that word bounds and digits cover every script.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import let

# fixed values: label and pattern, masked in this order
PII = (
    ("CPF", r"(?U)\b\d{3}\.?\d{3}\.?\d{3}-?\d{2}\b"),
    ("CNPJ", r"(?U)\b\d{2}\.?\d{3}\.?\d{3}/?\d{4}-?\d{2}\b"),
    ("EMAIL", r"(?U)\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"),
    ("TELEFONE", r"(?U)(?<!\d)(?:\+55\s?)?(?:\(?\d{2}\)?\s?)?(?:9\s?)?\d{4}[-\s]?\d{4}(?!\d)"),
)

# fixed values: name and pattern of a prompt injection
INJECTION = (
    ("ignore_instrucoes", r"(?iU)ignore\s+(all\s+)?(previous|prior|above)\s+instructions"),
    ("ignore_portugues", r"(?iU)ignore\s+(as\s+)?instru(c|ç)(o|õ)es"),
    ("reveal_system", r"(?iU)(reveal|show|print|dump)\s+(the\s+)?(system\s+)?prompt"),
    ("modo_desenvolvedor", r"(?iU)(modo|mode)\s+(desenvolvedor|developer|admin|root)"),
    ("tool_abuse", r"(?iU)(save_baseline|avaliar_regressao|regression/run)"),
    ("jailbreak_dan", r"(?iU)\bDAN\b|do\s+anything\s+now"),
)

# fixed values: texts shown to the user
DISCLAIMER = (
    "\n\n---\n*Assistente de apoio a negociacao. Valide numeros e decisoes com a equipe de compras.*"
)
EMPTY_MESSAGE = "Mensagem vazia."
INJECTION_MESSAGE = (
    "Sua mensagem foi bloqueada por padroes associados a manipulacao do assistente "
    "(injecao de prompt). Reformule a pergunta sobre negociacao de insumos."
)
PII_MESSAGE = (
    "Dados pessoais detectados (CPF, CNPJ, e-mail ou telefone). "
    "Remova-os antes de continuar — o chat nao deve processar PII."
)
LINK_REMOVED = "(link removido)"

# fixed values: construct that must not appear in data-frame code, and its name
UNSAFE_CODE = (
    (r"\bfrom\s+\S+\s+import\b", "import statement (from...import)"),
    (r"\bimport\b", "import statement (all imports forbidden; pandas and numpy are pre-imported by the executor)"),
    (r"\beval\s*\(", "eval()"),
    (r"\bexec\s*\(", "exec()"),
    (r"\bcompile\s*\(", "compile()"),
    (r"\b__import__\s*\(", "__import__()"),
    (r"\bopen\s*\(", "open()"),
    (r"\bbreakpoint\s*\(", "breakpoint()"),
    (r"\binput\s*\(", "input()"),
    (r"\braw_input\s*\(", "raw_input()"),
    (r"\bglobals\s*\(", "globals()"),
    (r"\blocals\s*\(", "locals()"),
    (r"\bgetattr\s*\(", "getattr()"),
    (r"\bsetattr\s*\(", "setattr()"),
    (r"\bdelattr\s*\(", "delattr()"),
    (r"\breload\s*\(", "reload()"),
    (r"\bfile\s*\(", "file()"),
    (r"\bexecfile\s*\(", "execfile()"),
    (r"\bos\.", "os module"),
    (r"\bsubprocess\.", "subprocess module"),
    (r"\bsys\.", "sys module"),
    (r"\bsocket\.", "socket module"),
    (r"\burllib\.", "urllib module"),
    (r"\brequests\.", "requests module"),
    (r"\b__builtins__\b", "__builtins__"),
    (r"\b__loader__\b", "__loader__"),
    (r"\b__spec__\b", "__spec__"),
    (r"\b__class__\b", "__class__ (reflection)"),
    (r"\b__subclasses__\s*\(", "__subclasses__()"),
    (r"\b__bases__\b", "__bases__"),
    (r"\b__mro__\b", "__mro__"),
    (r"\b__globals__\b", "__globals__"),
    (r"\b__code__\b", "__code__"),
    (r"\b__closure__\b", "__closure__"),
    (r"\bvars\s*\(", "vars()"),
    (r"\bdir\s*\(", "dir()"),
    (r"\b__dict__\b", "__dict__ (attribute reflection)"),
    (r"\b__module__\b", "__module__ (module reflection)"),
)


# what a match must start with; fails fast where a pattern cannot start
_START = {"CPF": r"(?=\d)", "CNPJ": r"(?=\d)", "EMAIL": "", "TELEFONE": r"(?=[\d+(])"}


def _count(text: Column, part: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))


def redact_pii(text: Column) -> Column:
    """struct<text, actions>: every mask works on the text the masks before it left.

    Texts without a digit or an at sign are passed on untouched.  A mask has acted when its label
    occurs more often than before; no later mask can take a label away.
    """
    labels = {label: f"[{label} REDIGIDO]" for label, _ in PII}
    masked = text
    for label, pattern in PII:
        masked = F.regexp_replace(masked, "(?U)" + _START[label] + pattern.removeprefix("(?U)"), labels[label])

    def result(out: Column) -> Column:
        acted = [F.when(_count(out, mark) > _count(text, mark), F.lit(f"masked_{label}")) for label, mark in labels.items()]
        return F.struct(out.alias("text"), F.array_compact(F.array(*acted)).alias("actions"))

    untouched = F.struct(text.alias("text"), F.array().cast("array<string>").alias("actions"))
    return F.when(text.rlike(r"[@\p{Nd}]"), let(masked, result)).otherwise(untouched)


# a part every match holds in lower case, without letters that have other case forms
_HINTS = {
    "ignore_instrucoes": ("gnore",), "ignore_portugues": ("gnore",), "reveal_system": ("prompt",),
    "modo_desenvolvedor": ("mod",), "tool_abuse": ("ave_ba", "ava", "on/run"), "jailbreak_dan": ("dan", "anyth"),
}


def detect_injection(text: Column) -> Column:
    """Names of the injection patterns found; a plain search decides whether a pattern is tried."""

    def hits(lowered: Column) -> Column:
        found = []
        for name, pattern in INJECTION:
            hint = F.contains(lowered, F.lit(_HINTS[name][0]))
            for part in _HINTS[name][1:]:
                hint = hint | F.contains(lowered, F.lit(part))
            found.append(F.when(hint & text.rlike(pattern), F.lit(name)))
        return F.array_compact(F.array(*found))

    return let(F.lower(text), hits)


_OPEN, _MID, _CLOSE = "\u0001", "\u0003", "\u0002"
# how the marks are written where a text holds them itself
_ESCAPES = (("\u0004", "\u0004d"), (_OPEN, "\u0004a"), (_CLOSE, "\u0004b"), (_MID, "\u0004c"))


def _escaped(text: Column) -> Column:
    for char, written in _ESCAPES:
        text = F.replace(text, F.lit(char), F.lit(written))
    return text


def _unescaped(text: Column) -> Column:
    for char, written in reversed(_ESCAPES):
        text = F.replace(text, F.lit(written), F.lit(char))
    return text


def _allowed_host(allowlist: Sequence[str]) -> str | None:
    """Pattern of an address whose host is listed or below a listed host."""
    hosts = sorted({h.lower().strip() for h in allowlist if h.strip()})
    if not hosts:
        return None
    names = "|".join(re.escape(h) for h in hosts)
    return (rf"(?i:(?:[a-z][a-z0-9+.\-]*:)?//(?:[^/?#{_CLOSE}]*@)?(?:[^/?#:@{_CLOSE}]+\.)*(?:{names}))"
            rf"(?::[^/?#@{_CLOSE}]*)?(?:[/?#][^{_CLOSE}]*)?")


def sanitize_links(text: Column, allowlist: Sequence[str]) -> Column:
    """struct<text, actions>: Markdown links and bare addresses outside the list are replaced.

    Every link is marked first, then the marks of allowed ones are lifted; the marks left over are
    the links to strip, one action each.
    """
    allowed = _allowed_host(allowlist)
    marked = F.regexp_replace(_escaped(text), r"\[([^\]]+)\]\(([^)]+)\)", f"{_OPEN}$1{_MID}$2{_CLOSE}")
    if allowed:
        marked = F.regexp_replace(
            marked, rf"(?U){_OPEN}([^{_CLOSE}{_MID}]*){_MID}(\s*{allowed}\s*){_CLOSE}", "[$1]($2)")

    def bare(links: Column) -> Column:
        plain = F.regexp_replace(links, rf"{_OPEN}([^{_CLOSE}{_MID}]*){_MID}[^{_CLOSE}]*{_CLOSE}", f"$1 {LINK_REMOVED}")
        urls = F.regexp_replace(plain, r"(?iU)(?<!\]\()(https?://[^\s<>]+)", f"{_OPEN}$1{_CLOSE}")
        if allowed:
            urls = F.regexp_replace(urls, rf"{_OPEN}({allowed}){_CLOSE}", "$1")
        return F.struct(_count(links, _OPEN).alias("n"), urls.alias("t"))

    def result(step: Column) -> Column:
        return F.struct(
            _unescaped(F.regexp_replace(step["t"], rf"{_OPEN}[^{_CLOSE}]*{_CLOSE}", LINK_REMOVED)).alias("text"),
            F.array_repeat(F.lit("stripped_link"), step["n"] + _count(step["t"], _OPEN)).alias("actions"))

    untouched = F.struct(text.alias("text"), F.array().cast("array<string>").alias("actions"))
    return F.when(F.contains(text, F.lit("](")) | F.contains(F.lower(text), F.lit("://")),
                  let(let(marked, bare), result)).otherwise(untouched)


def holds_any(text: Column, terms: Sequence[str]) -> Column:
    """Any non-empty term occurs in the text, in any case."""
    lowered = [t.lower() for t in terms if t]
    if not lowered:
        return F.lit(False)
    content = F.lower(text)
    if len(lowered) <= 32:
        hit = content.contains(lowered[0])
        for term in lowered[1:]:
            hit = hit | content.contains(term)
        return hit
    return F.exists(F.array(*map(F.lit, lowered)), lambda term: F.contains(content, term))


def unsafe_code_flag(code: Column) -> Column:
    """Why the code must not run, null when nothing forbidden is found."""
    return F.coalesce(
        *[F.when(code.rlike(p), F.lit(f"Forbidden construct: {reason}")) for p, reason in UNSAFE_CODE])
