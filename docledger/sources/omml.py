"""Office math as LaTeX: runs, fractions, scripts, radicals, n-ary operators, delimiters, matrices, functions, accents, bars."""

from __future__ import annotations

from docledger.sources.xmltree import M, Element

#: Commands of symbols.
SYMBOLS = {
    "α": r"\alpha", "β": r"\beta", "γ": r"\gamma", "δ": r"\delta", "ε": r"\epsilon", "θ": r"\theta", "λ": r"\lambda", "μ": r"\mu", "π": r"\pi", "ρ": r"\rho", "σ": r"\sigma", "τ": r"\tau",
    "φ": r"\phi", "ω": r"\omega", "Δ": r"\Delta", "Σ": r"\Sigma", "Ω": r"\Omega", "×": r"\times", "÷": r"\div", "±": r"\pm", "≤": r"\leq", "≥": r"\geq", "≠": r"\neq", "≈": r"\approx",
    "∞": r"\infty", "∂": r"\partial", "∇": r"\nabla", "→": r"\rightarrow", "∈": r"\in", "⋅": r"\cdot",
}
#: N-ary operators, accents and named functions.
NARY = {"∑": r"\sum", "∏": r"\prod", "∫": r"\int", "∬": r"\iint", "∮": r"\oint", "⋃": r"\bigcup", "⋂": r"\bigcap"}
ACCENTS = {"̂": r"\hat", "̃": r"\tilde", "̄": r"\bar", "̅": r"\overline", "⃗": r"\vec", "̇": r"\dot", "̈": r"\ddot"}
FUNCTIONS = ("arccos", "arcsin", "arctan", "cos", "cosh", "cot", "det", "exp", "lim", "ln", "log", "max", "min", "sin", "sinh", "tan", "tanh")


def latex(e: Element) -> str:
    """LaTeX of an element of office math."""
    rule = _RULES.get(e.name) if e.uri == M else None
    return rule(e) if rule else _inside(e)


def _inside(e: Element | None) -> str:
    return "" if e is None else "".join(latex(c) for c in e.children if not c.name.endswith("Pr"))


def _part(e: Element, name: str) -> str:
    return _inside(e.down(name, uri=M))


def _option(e: Element, properties: str, name: str, default: str) -> str:
    found = e.down(properties, name, uri=M)
    value = found.val(M) if found is not None else None
    return default if value is None else value


def _run(e: Element) -> str:
    text = "".join(t.text for t in e.children if t.name == "t")
    return "".join(f"{SYMBOLS[c]} " if c in SYMBOLS else c for c in text)


def _fraction(e: Element) -> str:
    return rf"\frac{{{_part(e, 'num')}}}{{{_part(e, 'den')}}}"


def _root(e: Element) -> str:
    degree = _part(e, "deg")
    return rf"\sqrt[{degree}]{{{_part(e, 'e')}}}" if degree else rf"\sqrt{{{_part(e, 'e')}}}"


def _scripts(e: Element, lower: bool, upper: bool) -> str:
    return _part(e, "e") + (f"_{{{_part(e, 'sub')}}}" if lower else "") + (f"^{{{_part(e, 'sup')}}}" if upper else "")


def _nary(e: Element) -> str:
    sign = _option(e, "naryPr", "chr", "∫")
    lower, upper = _part(e, "sub"), _part(e, "sup")
    return NARY.get(sign, sign) + (f"_{{{lower}}}" if lower else "") + (f"^{{{upper}}}" if upper else "") + f"{{{_part(e, 'e')}}}"


def _delimiters(e: Element) -> str:
    begin, end, gap = (_option(e, "dPr", n, d) for n, d in (("begChr", "("), ("endChr", ")"), ("sepChr", "|")))
    inner = gap.join(_inside(c) for c in e.all("e", M))
    written = {"{": r"\{", "}": r"\}", "": "."}
    return rf"\left{written.get(begin, begin)}{inner}\right{written.get(end, end)}"


def _matrix(e: Element) -> str:
    rows = r" \\ ".join(" & ".join(_inside(c) for c in row.all("e", M)) for row in e.all("mr", M))
    return rf"\begin{{matrix}}{rows}\end{{matrix}}"


def _function(e: Element) -> str:
    name = _part(e, "fName")
    return (rf"\{name}" if name in FUNCTIONS else name) + f"{{{_part(e, 'e')}}}"


def _accent(e: Element) -> str:
    return f"{ACCENTS.get(_option(e, 'accPr', 'chr', chr(0x302)), chr(92) + 'hat')}{{{_part(e, 'e')}}}"


def _bar(e: Element) -> str:
    return (r"\overline" if _option(e, "barPr", "pos", "bot") == "top" else r"\underline") + f"{{{_part(e, 'e')}}}"


def _limit(e: Element) -> str:
    return f"{_part(e, 'e')}{'_' if e.name == 'limLow' else '^'}{{{_part(e, 'lim')}}}"


def _before(e: Element) -> str:
    return f"{{}}_{{{_part(e, 'sub')}}}^{{{_part(e, 'sup')}}}{_part(e, 'e')}"


def _lines(e: Element) -> str:
    rows = r" \\ ".join(_inside(c) for c in e.all("e", M))
    return rf"\begin{{aligned}}{rows}\end{{aligned}}"


_RULES = {
    "r": _run,
    "f": _fraction,
    "rad": _root,
    "sSub": lambda e: _scripts(e, True, False),
    "sSup": lambda e: _scripts(e, False, True),
    "sSubSup": lambda e: _scripts(e, True, True),
    "sPre": _before,
    "nary": _nary,
    "d": _delimiters,
    "m": _matrix,
    "func": _function,
    "acc": _accent,
    "bar": _bar,
    "limLow": _limit,
    "limUpp": _limit,
    "eqArr": _lines,
}
