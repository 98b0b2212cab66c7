"""Modifiers for scanned languages: edits by position over source whose strings and comments are masked.

Each family is one function for all languages; tables give what differs. They work on tokens and paired
delimiters, not on a syntax tree, and a result whose delimiters no longer pair is thrown away.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from . import scan as base

Flip = Callable[[], bool]
Edits = list[tuple[int, int, str]]

# Opposites of operators. Comparisons are mirrored in some languages and negated in others.
MIRRORED = {"<": ">", ">": "<", "<=": ">=", ">=": "<=", "==": "!=", "!=": "=="}
NEGATED = {"<": ">=", ">": "<=", "<=": ">", ">=": "<", "==": "!=", "!=": "==", "===": "!==", "!==": "==="}
LOGIC = {"&&": "||", "||": "&&"}
ARITHMETIC = {"+": "-", "-": "+", "*": "/", "/": "*", "%": "*"}
SHIFTS = {"<<": ">>", ">>": "<<", "&": "|", "|": "&", "^": "&"}
FLIPS = {
    "go": MIRRORED | LOGIC | ARITHMETIC | SHIFTS, "rs": MIRRORED | LOGIC | ARITHMETIC | SHIFTS,
    "rb": MIRRORED | LOGIC | ARITHMETIC | {"<<": ">>", ">>": "<<", "**": "*"}, "js": NEGATED | LOGIC | ARITHMETIC,
    "php": NEGATED | LOGIC, "java": NEGATED | LOGIC, "cpp": NEGATED | LOGIC | SHIFTS,
}
GROUPS = (("+", "-"), ("*", "/", "%"), ("&", "|", "^"), ("<<", ">>"), ("<", ">", "<=", ">="), ("==", "!="), ("&&", "||"))
COMPOUND = {"+=": "-=", "-=": "+=", "*=": "/=", "/=": "*=", "++": "--", "--": "++"}
LITERAL_PAIRS = {"true": "false", "false": "true", "GET": "POST", "POST": "GET", "asc": "desc", "desc": "asc"}
#: Languages that pick from a whole group, the current operator included, so that a call may change nothing.
WHOLE_GROUP = {"go", "rs", "rb"}
#: Languages in which a call changes one site, chosen after one coin flip; others flip a coin per site.
ONE_SITE = {"java", "cpp"}

_OPERATOR = re.compile(r"(?<=[\w)\]\s])(===|!==|\*\*|<<|>>|<=|>=|==|!=|&&|\|\||[-+*/%&|^<>])(?=\s)(?!=)")
_NUMBER = re.compile(r"(?<![\w.])(\d+(?:\.\d+)?)(?![\w.])")
_OPERAND = r"(?:[\w.\[\]$:&*!]|->)+(?:\([^()]*\))?"


def _pick(sites: Edits, ext: str, c: base.Choice, flip: Flip) -> Edits:
    if ext in ONE_SITE:
        return [c.of(sites)] if sites and flip() else []
    return [s for s in sites if flip()]


def _operators(src: str, ext: str) -> list[re.Match]:
    code = base.mask(src, ext)
    return [m for m in _OPERATOR.finditer(code, code.find("\n" if ext == "rb" else "{"))]


def change_operator(src: str, ext: str, c: base.Choice, flip: Flip) -> Edits:
    sites = []
    for m in _operators(src, ext):
        group = next((g for g in GROUPS if m[1] in g), None)
        if group:
            options = list(group) if ext in WHOLE_GROUP else [o for o in group if o != m[1]]
            sites.append((m.start(1), m.end(1), str(c.of(options))))
    return _pick(sites, ext, c, flip)


def flip_operator(src: str, ext: str, c: base.Choice, flip: Flip) -> Edits:
    table = FLIPS[{"ts": "js", "tsx": "js", "jsx": "js"}.get(ext, ext)]
    return _pick([(m.start(1), m.end(1), table[m[1]]) for m in _operators(src, ext) if m[1] in table], ext, c, flip)


def swap_operands(src: str, ext: str, c: base.Choice, flip: Flip) -> Edits:
    code, sites = base.mask(src, ext), []
    for m in re.finditer(rf"({_OPERAND})(\s+(?:[-+*/%]|<=?|>=?|==|!=)\s+)({_OPERAND})", code):
        a, op, b = src[m.start(1) : m.end(1)], src[m.start(2) : m.end(2)], src[m.start(3) : m.end(3)]
        if a != b and a not in ("return", "if", "while", "in"):
            sites.append((m.start(), m.end(), f"{b}{op}{a}"))
    return _pick(sites, ext, c, flip)


def break_chain(src: str, ext: str, c: base.Choice, flip: Flip) -> Edits:
    code, sites = base.mask(src, ext), []
    for m in re.finditer(rf"({_OPERAND})\s+([-+*/%])\s+({_OPERAND})\s+[-+*/%]\s+({_OPERAND})", code):
        kept = m[1] if ext == "rs" else f"{m[1]} {m[2]} {m[4]}"
        sites.append((m.start(), m.end(), kept))
    if ext == "java":  # the outer call of a chain of calls
        sites = [(m.start(1), m.end(1), "") for m in re.finditer(r"\)(\.\w+\([^()]*\))(?=[;,)\s])", code)]
    return _pick(sites, ext, c, flip)


def change_constant(src: str, ext: str, c: base.Choice, flip: Flip) -> Edits:
    code, sites = base.mask(src, ext), []
    steps = {"js": (1, 2), "ts": (1, 2), "php": (1, 2), "java": (1, 10)}.get(ext, (1,))
    for m in _NUMBER.finditer(code, max(code.find("{"), 0)):
        step = int(c.of(list(steps))) * int(c.of([-1, 1]))
        fresh = f"{float(m[1]) + step / 10:g}" if "." in m[1] else str(int(m[1]) + step)
        sites.append((m.start(), m.end(), fresh))
    return _pick(sites, ext, c, flip)


def swap_compound(src: str, ext: str, c: base.Choice, flip: Flip) -> Edits:
    code = base.mask(src, ext)
    sites = [(m.start(), m.end(), COMPOUND[m[0]]) for m in re.finditer(r"[-+*/]=(?!=)|\+\+|--", code)]
    return _pick(sites, ext, c, flip)


def flip_counter(src: str, ext: str, c: base.Choice, flip: Flip) -> Edits:
    return _pick([(m.start(), m.end(), COMPOUND[m[0]]) for m in re.finditer(r"\+\+|--", base.mask(src, ext))], ext, c, flip)


def _ternaries(code: str) -> list[re.Match]:
    return list(re.finditer(r"(?P<q>[^=(,?\n;]+?)\s\?\s(?P<a>[^?:\n;]+?)\s:\s(?P<b>[^?:\n;,)]+)", code))


def swap_ternary(src: str, ext: str, c: base.Choice, flip: Flip) -> Edits:
    part = lambda m, g: src[m.start(g) : m.end(g)]
    sites = [(m.start("a"), m.end("b"), f"{part(m, 'b')} : {part(m, 'a')}") for m in _ternaries(base.mask(src, ext))]
    return _pick(sites, ext, c, flip)


def drop_ternary(src: str, ext: str, c: base.Choice, flip: Flip) -> Edits:
    sites = []
    for m in _ternaries(base.mask(src, ext)):
        keep = str(c.of(["a", "b"]))
        sites.append((m.start("q") + len(m["q"]) - len(m["q"].lstrip()), m.end("b"), src[m.start(keep) : m.end(keep)]))
    return _pick(sites, ext, c, flip)


def swap_arguments(src: str, ext: str, c: base.Choice, flip: Flip) -> Edits:
    code, sites = base.mask(src, ext), []
    for m in re.finditer(r"\w\(([^(){}]+)\)", code[code.find("{") :] if "{" in code else code):
        shift = max(code.find("{"), 0)
        a, b = m.start(1) + shift, m.end(1) + shift
        cuts = [a, *(i + 1 for i in range(a, b) if code[i] == ","), b + 1]
        parts = [src[x : y - 1].strip() for x, y in zip(cuts, cuts[1:], strict=False)]
        if len(parts) > 1 and all(parts):
            i = int(c.of(list(range(len(parts) - 1))))
            parts[i], parts[i + 1] = parts[i + 1], parts[i]
            sites.append((a, b, ", ".join(parts)))
    return _pick(sites, ext, c, flip)


def _statements(src: str, ext: str, words: str) -> list[tuple[int, int, int, int]]:
    """(start, end, body start, body end) of statements with a block that start with one of the words."""
    code, out = base.mask(src, ext), []
    if ext == "rb":
        for m in re.finditer(rf"(?m)^([ \t]*)(?:{words})\b[^\n]*\n", code):
            if end := re.compile(rf"(?m)^{m[1]}end\b\n?").search(code, m.end()):
                out.append((m.start(), end.end(), m.end(), end.start()))
        return out
    for m in re.finditer(rf"(?m)(?<![\w.])(?:{words})\b[^;{{}}]*(?:;[^;{{}}]*;[^{{}}]*)?\{{", code):
        if (end := base.closing(code, m.end() - 1)) > 0:
            stop = end + 1
            while e := re.compile(r"\s*else\b[^{};]*\{").match(code, stop):
                stop = base.closing(code, e.end() - 1) + 1
                if stop <= 0:
                    stop = end + 1
                    break
            out.append((m.start(), stop, m.end(), end))
    return out


def _removed(words: str) -> Callable:
    def run(src: str, ext: str, c: base.Choice, flip: Flip) -> Edits:
        found = _statements(src, ext, words)
        bare = ext == "cpp" or (ext == "java" and words.startswith("if"))  # replaced by its body
        return _pick([(a, b, src[x:y].strip() if bare else "") for a, b, x, y in found], ext, c, flip)

    return run


remove_loop = _removed("for|while|loop|foreach|until")
remove_conditional = _removed("if|unless|switch")


def remove_try(src: str, ext: str, c: base.Choice, flip: Flip) -> Edits:
    sites, code = [], base.mask(src, ext)
    for a, b, x, y in _statements(src, ext, "try"):
        while m := re.compile(r"\s*(?:catch|finally)\b[^{};]*\{").match(code, b):
            b = base.closing(code, m.end() - 1) + 1
        sites.append((a, b, src[x:y].strip()))
    return _pick(sites, ext, c, flip)


def remove_null_check(src: str, ext: str, c: base.Choice, flip: Flip) -> Edits:
    code = base.mask(src, ext)
    sites = [(a, b, src[x:y].strip()) for a, b, x, y in _statements(src, ext, "if") if re.match(r"if\s*\(\s*\w+\s*!=\s*null\s*\)", code[a:x])]
    sites += [(m.start(), m.end(), "") for m in re.finditer(r"\w+\s*!=\s*null\s*&&\s*", code)]
    return _pick(sites, ext, c, flip)


def remove_assignment(src: str, ext: str, c: base.Choice, flip: Flip) -> Edits:
    end = r"\n" if ext in ("go", "rb") else r";[ \t]*\n?"
    pattern = rf"(?m)^[ \t]*(?:(?:let|const|var|mut|final|auto)\s+)*[\w.$@\[\]:*<> ]+\s*(?:[-+*/|&:]|\|\|)?=(?![=>~])[^\n{{}}]*?{end}"
    code = base.mask(src, ext)
    return _pick([(m.start(), m.end(), "") for m in re.finditer(pattern, code) if m.start()], ext, c, flip)


def invert_if(src: str, ext: str, c: base.Choice, flip: Flip) -> Edits:
    code, sites = base.mask(src, ext), []
    if ext == "rb":
        for m in re.finditer(r"(?m)^([ \t]*)if\b[^\n]*\n((?:(?!\1(?:elsif|else|end)\b).*\n)*)\1else\n((?:(?!\1end\b).*\n)*)\1end", code):
            sites.append((m.start(2), m.end(3), src[m.start(3) : m.end(3)] + src[m.end(2) : m.start(3)] + src[m.start(2) : m.end(2)]))
        return _pick(sites, ext, c, flip)
    for a, b, x, y in _statements(src, ext, "if"):
        m = re.compile(r"\}(\s*else\s*)\{").match(code, y)
        if m and (end := base.closing(code, m.end() - 1)) > 0:
            sites.append((x, end, src[m.end() : end] + src[y : m.end()] + src[x:y]))
    return _pick(sites, ext, c, flip)


def shuffle_lines(src: str, ext: str, c: base.Choice, flip: Flip) -> Edits:
    """Top-level statements of the body, as runs of lines at the body's own indentation."""
    lines = src.split("\n")
    body = lines[1:-1]
    if len(body) < 2 or not flip():
        return []
    indent = min((len(x) - len(x.lstrip()) for x in body if x.strip()), default=0)
    groups: list[list[str]] = []
    for x in body:
        own = x.strip() and len(x) - len(x.lstrip()) == indent and not re.match(r"\s*(?:[})\]]|else|end\b|elsif|rescue|ensure)", x)
        if own or not groups:
            groups.append([])
        groups[-1].append(x)
    mixed = [x for g in c.shuffled(groups) for x in g]
    return [(0, len(src), "\n".join([lines[0], *mixed, lines[-1]]))]


def swap_break(src: str, ext: str, c: base.Choice, flip: Flip) -> Edits:
    other = {"break": "continue", "continue": "break"}
    sites = [(m.start(1), m.end(1), other[m[1]]) for m in re.finditer(r"\b(break|continue)\b(?=\s*\w*\s*;)", base.mask(src, ext))]
    if ext == "java":  # all of them
        return sites if flip() else []
    return _pick(sites, ext, c, flip)


def off_by_one(src: str, ext: str, c: base.Choice, flip: Flip) -> Edits:
    code, pairs, sites = base.mask(src, ext), {"<": "<=", "<=": "<", ">": ">=", ">=": ">"}, []
    for m in re.finditer(r"\b(?:for|while)\s*\([^{}]*\)", code):
        sites += [(o.start(1) + m.start(), o.end(1) + m.start(), pairs[o[1]]) for o in re.finditer(r"\s(<=?|>=?)\s", m[0])]
    return _pick(sites, ext, c, flip)


def negate(src: str, ext: str, c: base.Choice, flip: Flip) -> Edits:
    code = base.mask(src, ext)
    sites = [(m.start(), m.end(), LITERAL_PAIRS[m[0]]) for m in re.finditer(r"\b(?:true|false)\b", code)]
    if ext == "java":
        sites += [(m.start(1), m.end(1), "") for m in re.finditer(r"(?<=[(\s&|])(!)(?=\w)", code)]
        sites += [(m.start(1), m.start(1), "!") for m in re.finditer(r"\bif\s*\(\s*([\w.]+(?:\(\))?)\s*\)", code)]
    return _pick(sites, ext, c, flip)


def return_null(src: str, ext: str, c: base.Choice, flip: Flip) -> Edits:
    if re.match(r"(?:\w+\s+)*(?:void|int|long|boolean|double|float|char|short|byte)\s+\w+\s*\(", src.strip()):
        return []
    code = base.mask(src, ext)
    return _pick([(m.start(1), m.end(1), "null") for m in re.finditer(r"\breturn\s+([^;{}]+);", code) if m[1] != "null"], ext, c, flip)


def string_change(src: str, ext: str, c: base.Choice, flip: Flip) -> Edits:
    sites = []
    for m in re.finditer(r'"((?:\\.|[^"\\\n])+)"', src):
        text = m[1]
        if text in LITERAL_PAIRS:
            fresh = LITERAL_PAIRS[text]
        elif len(text) > 1 and "\\" not in text:
            i = int(c.of(list(range(len(text) - 1))))
            fresh = text[:i] + text[i + 1] + text[i] + text[i + 2 :]
        else:
            fresh = text + "_"
        sites.append((m.start(1), m.end(1), fresh))
    return _pick(sites, ext, c, flip)


def _ruby(pattern: str, into: str | Callable[[re.Match], str], keep: Callable[[re.Match, str], bool] = lambda m, s: True) -> Callable:
    """One random site of a pattern over the masked source, replaced."""

    def run(src: str, ext: str, c: base.Choice, flip: Flip) -> Edits:
        code = base.mask(src, ext)
        sites = [
            (m.start(), m.end(), m.expand(into) if isinstance(into, str) else into(m)) for m in re.finditer(pattern, code) if keep(m, code)
        ]
        return [c.of(sites)] if sites and flip() else []

    return run


def _line_of(m: re.Match, code: str) -> str:
    return code[code.rfind("\n", 0, m.start()) + 1 : code.find("\n", m.end())]


_RUBY = {
    "func_pm_guard_clause_invert": (_ruby(r"(?m)(?<=\S )(if|unless)(?= [^\n]+$)", lambda m: "unless" if m[1] == "if" else "if"),
                                    "A guard clause conditional has been inverted", ("has_if",), 0.6),
    "func_pm_ruby_safe_nav_removal": (_ruby(r"&\.", "."), "A safe navigation operator (&.) has been removed, allowing nil to propagate", ("has_function_call",), 0.5),
    "func_pm_ruby_or_default_removal": (_ruby(r" \|\| [\w\[\]{}:.]+", "", lambda m, s: not re.match(r"\s*(?:if|unless|while)\b", _line_of(m, s))),
                                        "A fallback default (`or` value) has been removed, allowing nil to propagate", ("has_binary_op",), 0.4),
    "func_pm_ruby_presence_strip": (_ruby(r"\.presence\b(?!\()", ""), "A .presence call has been removed", ("has_function_call",), 0.5),
    "func_pm_ruby_bang_method_strip": (_ruby(r"\b(first|last|take|find_by)!", r"\1"), "A bang method (!) has been replaced with its non-raising variant", ("has_function_call",), 0.4),
    "func_pm_ruby_or_equals_removal": (_ruby(r"\|\|=", "="), "A memoization operator (or-equals) has been replaced with plain assignment", ("has_assignment",), 0.4),
    "func_pm_ruby_nil_guard_removal": (_ruby(r"(?m)^[ \t]*(?:return|next|break|raise)\b[^\n]* (?:if|unless) [^\n]+\n", ""), "A nil guard clause has been removed", ("has_if",), 0.5),
    "func_pm_remove_rescue_ensure": (_ruby(r"(?m)^([ \t]*)(?:rescue|ensure)\b[^\n]*\n(?:(?!\1(?:end|ensure|else)\b)[^\n]*\n)*", ""), "Exception handling (rescue/ensure) may be missing", ("has_exception",), 0.4),
    "func_pm_ruby_symbol_string_swap": (_ruby(r"(?<![:\w]):(\w+)\b(?![?!])", r'"\1"'), "A symbol/string type may be incorrect", (), 0.5),
    "func_pm_ruby_block_mutation": (_ruby(r"\|[\w, ]+\| ?|(?<=yield)[ (][^\n)]+\)?", ""), "Block parameters or yield arguments may be incorrect", (), 0.4),
}

_WHY = {
    "func_pm_ctrl_invert_if": (invert_if, "The if-else conditions may be out of order, or the bodies are inverted", ("has_if_else",)),
    "func_pm_ctrl_shuffle": (shuffle_lines, "The lines inside a function may be out of order", ("has_loop",)),
    "func_pm_op_change": (change_operator, "The operations in an expression are likely incorrect", ("has_binary_op",)),
    "func_pm_flip_operators": (flip_operator, "The operators in an expression are likely incorrect", ("has_binary_op",)),
    "func_pm_op_flip": (flip_operator, "The operators in an expression are likely incorrect", ("has_binary_op",)),
    "func_pm_op_swap": (swap_operands, "The operands in an expression are likely in the wrong order", ("has_binary_op",)),
    "func_pm_op_break_chains": (break_chain, "There are expressions or mathematical operations that are likely incomplete", ("has_binary_op",)),
    "func_pm_op_change_const": (change_constant, "The constants in an expression might be incorrect", ("has_binary_op",)),
    "func_pm_remove_loop": (remove_loop, "There is one or more missing loops that is causing the bug", ("has_loop",)),
    "func_pm_remove_cond": (remove_conditional, "There is one or more missing conditionals that causes the bug", ("has_if",)),
    "func_pm_remove_assign": (remove_assignment, "There is likely a missing assignment in the code", ("has_assignment",)),
    "func_pm_aug_assign_swap": (swap_compound, "The augmented assignment or update operator is likely incorrect", ("has_assignment",)),
    "func_pm_ternary_swap": (swap_ternary, "The ternary operator branches may be swapped or the condition may be incorrect", ("has_ternary",)),
    "func_pm_remove_ternary": (drop_ternary, "A ternary conditional expression may be missing - only one branch is being used", ("has_ternary",)),
    "func_pm_arg_swap": (swap_arguments, "The function arguments may be in the wrong order", ("has_function_call",)),
    "func_pm_loop_break_continue_swap": (swap_break, "Break and continue statements in loops may be swapped", ("has_loop",)),
    "func_pm_loop_off_by_one": (off_by_one, "Loop boundaries may be off by one", ("has_loop",)),
    "func_pm_bool_negate": (negate, "Negated a boolean expression", ()),
    "func_pm_return_null": (return_null, "Changed return value to null", ()),
    "func_pm_remove_try_catch": (remove_try, "Try-catch blocks may be missing or incomplete", ()),
    "func_pm_remove_null_check": (remove_null_check, "Null checks may be missing in the code", ("has_if",)),
    "func_pm_string_literal_change": (string_change, "String literals may have incorrect values", ()),
    "func_pm_string_typo": (string_change, "A typo has been introduced in a string constant", ()),
    "func_pm_inc_dec_flip": (flip_counter, "The increment/decrement operation in the code is likely incorrect", ("has_unary_op",)),
}
_COMMON = ("ctrl_invert_if", "ctrl_shuffle", "op_change", "op_swap", "op_break_chains", "op_change_const", "remove_loop", "remove_cond", "remove_assign")
_SCRIPT = (*_COMMON, "op_flip", "aug_assign_swap", "ternary_swap", "arg_swap", "remove_ternary")
# What each language has, and the likelihood of each.
_LANGUAGES: dict[str, tuple[tuple[str, ...], float]] = {
    "go": ((*_COMMON, "flip_operators"), 0.4), "rs": ((*_COMMON, "flip_operators"), 0.5), "rb": ((*_COMMON, "flip_operators"), 0.4),
    "js": (_SCRIPT, 0.5), "ts": (_SCRIPT, 0.5), "php": (_SCRIPT, 0.5),
    "java": (("bool_negate", "ctrl_invert_if", "string_literal_change", "loop_break_continue_swap", "loop_off_by_one", "op_change", "flip_operators",
              "op_swap", "op_change_const", "op_break_chains", "remove_cond", "remove_assign", "return_null", "remove_try_catch", "remove_null_check"), 0.5),
    "cpp": ((*_COMMON, "loop_break_continue_swap", "flip_operators", "inc_dec_flip", "aug_assign_swap", "bool_negate", "string_typo"), 0.5),
}
_LIKELY = {"ctrl_invert_if": {"go": 0.75, "java": 0.75, "rb": 0.75}, "ctrl_shuffle": {"go": 0.75, "rb": 0.75}, "remove_loop": {"go": 0.25, "rb": 0.25},
           "remove_cond": {"go": 0.25, "rb": 0.25, "java": 0.4}, "remove_assign": {"go": 0.25, "rb": 0.25, "java": 0.4},
           "op_change": {"java": 0.6}, "flip_operators": {"java": 0.6}, "op_break_chains": {"java": 0.3, "rb": 0.3}, "return_null": {"java": 0.4},
           "remove_try_catch": {"java": 0.4}, "loop_break_continue_swap": {"java": 0.6}, "loop_off_by_one": {"java": 0.6}}


def _registry() -> dict[str, dict[str, tuple]]:
    out: dict[str, dict[str, tuple]] = {}
    for ext, (names, usual) in _LANGUAGES.items():
        for short in names:
            make, why, needs = _WHY[f"func_pm_{short}"]
            tags = ("is_function", *needs) if needs or short not in ("bool_negate", "return_null") or ext == "cpp" else ()
            least = (1 if ext == "cpp" else 5) if short == "ctrl_invert_if" else 3
            most = 10 if short == "ctrl_shuffle" and ext != "cpp" else 10**6
            out.setdefault(ext, {})[f"func_pm_{short}"] = (make, why, tags, least, most, _LIKELY.get(short, {}).get(ext, usual))
    for name, (make, why, needs, p) in _RUBY.items():
        out["rb"][name] = (make, why, ("is_function", *needs), 3, 10**6, p)
    for twin, of in (("tsx", "ts"), ("jsx", "js"), ("cc", "cpp"), ("hpp", "cpp")):
        out[twin] = out[of]
    return out


SCANNED = _registry()


def valid_scan(src: str, ext: str) -> bool:
    """Whether delimiters pair; for Ruby, whether blocks and ends balance."""
    code, stack = base.mask(src, ext), []
    for ch in code:
        if ch in "([{":
            stack.append(ch)
        elif ch in ")]}":
            if not stack or stack.pop() + ch not in ("()", "[]", "{}"):
                return False
    if ext == "rb":
        opens = len(re.findall(r"(?m)^\s*(?:def|if|unless|while|until|case|begin|class|module|for)\b|\bdo\b(?:\s*\|[^|]*\|)?\s*$", code))
        return not stack and opens == len(re.findall(r"(?m)^\s*end\b", code))
    return not stack
