"""Personal data by bootstrapped contextual extraction.

Seeds are e-mail addresses, IP addresses, card and phone numbers found by their
form.  The words before them become lexical patterns.  Patterns and instances
form a graph: a pattern's confidence in a kind is the share of its instances
known to be of that kind, an instance's is what its patterns together say.  A
few rounds of both spread the seeds; identifiers of unknown form that follow a
pattern of high confidence are then added.

Which unknown forms can follow depends on the kind.  E-mail: whatever holds an
``@``, and words joined by "at" or "dot", bare or in brackets.  IP, card, phone:
words with a digit and the groups of digits joined to them over single blanks;
for IP also hexadecimal groups between colons.  Words with four digits or more
can be of every kind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of, written

KINDS = ("email", "ip", "card", "phone")
# A pattern needs this many distinct known instances and this confidence
SUPPORT, CONFIDENCE, ROUNDS = 5, 0.8, 3
LEFT_CHARS = 60
# Opening quotes and brackets right before an instance
_QUOTES = r"""[<(\[{"']+$"""

# Control characters that no pattern matches: ends of a match, joined separators,
# and what stands for them where a text holds them itself
_CUT, _JOIN, _DOT, _OWN = "\x01", "\x04", "\x05", "\x03"


def _q(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


# Runs start where the character before is not of the run, or where the last match
# ended; with possessive repeats and single-character classes no text makes the
# matcher back up or nest.
_LOCAL = f"A-Za-z0-9._%+{_DOT}-"
_PATTERNS = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++{_DOT}[A-Za-z0-9{_DOT}-]++",
    "ip": rf"(?:(?<![0-9])|\G)[0-9]++(?:{_DOT}[0-9]++){{3}}",
    "card": rf"[0-9][0-9{_JOIN}]++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# The text each kind is searched in, when it is searched at all, and what a match must satisfy
_IN = {"email": "_dots", "ip": "_dots", "card": "_joined", "phone": "_t"}
_IF = {"email": "instr(_t, '@') > 0", "ip": "_digits", "card": "_digits", "phone": "_digits AND instr(_t, '+') > 0"}
_DIGITS = "regexp_replace(p, '[^0-9]', '')"
_VALID = {
    "email": "true",
    "ip": f"forall(split(p, {_q(_DOT)}), q -> q RLIKE '^0*([0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$')",
    "card": f"""char_length({_DIGITS}) BETWEEN 14 AND 19 AND transform(array(reverse({_DIGITS})), d ->
                aggregate(transform(sequence(1, char_length(d)), i -> CAST(substring(d, i, 1) AS INT) * (2 - i % 2)),
                          0, (s, x) -> s + CASE WHEN x > 9 THEN x - 9 ELSE x END) % 10 = 0)[0]""",
    "phone": f"char_length({_DIGITS}) BETWEEN 10 AND 15",
}
# Unknown forms: words around "at" and "dot", groups of digits over single blanks (also around a hyphen, slash, dot
# or "dot"), up to the punctuation that ends a word
_B, _WORD, _DIGITS_OF = r"[ \t\xA0]", r"[\p{L}\p{N}.!#$%&'*+/?^_~|-]", r"[(\[+]*+[0-9][0-9()\[\]./+-]*+"
_OPEN, _CLOSE, _ENDS = rf"{_B}?[\[({{<]{_B}?", rf"{_B}?[\])}}>]{_B}?", r"(?=[,;:!?\"'<>]*+(?:\s|\z))"
_AT = rf"(?:{_B}?@{_B}?|{_OPEN}(?:at|@){_CLOSE})"
_POINT = rf"(?:{_OPEN}(?:dot|\.){_CLOSE}|{_B}dot{_B})"
_ADDRESS = (rf"(?i:(?<!{_WORD}){_WORD}++(?:{_AT}{_WORD}++(?:(?:{_POINT}|{_B}\.{_B}){_WORD}++)++"
            rf"|(?:(?:{_AT}|{_POINT}|{_B}at{_B}){_WORD}++)++))"
            r"|(?<![^\s@:=<>()\[\]{},;\"])[^\s@:=<>()\[\]{},;\"]*+@[^\s<>,;\"]*+"
            r"|(?<!\S)(?=\S*?(?:[._-](?i:at|dot)[._-]|[a-z0-9](?:AT|DOT)[a-z0-9]))\S++")
_NUMBER = (rf"(?:{_DIGITS_OF}(?:(?<=[0-9)\]]){_B}(?:(?:[-–/.]|[(\[]?dot[)\]]?){_B})?{_DIGITS_OF}{_ENDS})*+{_ENDS}"
           r"|[^\s0-9]*+[0-9]\S*+)")
_COLONS = r"(?<![\p{L}\p{N}:])[0-9A-Fa-f]{0,4}+:[0-9A-Fa-f]{0,4}+:[0-9A-Fa-f:.]*+(?![\p{L}\p{N}])"
# The kinds a form can be of (bit k for kind k), when a text is searched, and the form; the third is behind a label
_MAIL, _IP, _NUMERIC = 1, 2, 14
_FORMS = [(_MAIL, "_t RLIKE '@|(?i:at|dot)'", _ADDRESS), (_NUMERIC, "_digits", rf"(?<!\S){_NUMBER}"),
          (_NUMERIC, "_digits", rf"(?<=\p{{L}}[:=#]){_NUMBER}"), (_IP, "instr(_t, ':') > 0", _COLONS)]
_HOLDS = {_MAIL: "(?is)@|(?:at|dot).", _IP: "[0-9A-Fa-f]", _NUMERIC: "[0-9]"}

_SPAN = "array<struct<start:int,kind:int,end:int,value:string,left:string>>"


def _found(text: str, pattern: str, when: str, kind: int, valid: str) -> str:
    """SQL for all valid matches of a pattern in a text, with their positions and what stands before them."""
    return f"""CASE WHEN {when} THEN aggregate(
        split(regexp_replace({text}, {_q(pattern)}, {_q(_CUT + '$0' + _CUT)}), {_q(_CUT)}, -1),
        named_struct('at', 0, 'odd', false, 'left', '', 'out', CAST(array() AS {_SPAN})),
        (a, p) -> named_struct(
          'at', a.at + char_length(p), 'odd', NOT a.odd, 'left', right(concat(a.left, p), {LEFT_CHARS}),
          'out', CASE WHEN a.odd AND ({valid})
                      THEN concat(a.out, array(named_struct('start', a.at, 'kind', {kind},
                                                            'end', a.at + char_length(p), 'value', p, 'left', a.left)))
                      ELSE a.out END),
        a -> a.out) ELSE CAST(array() AS {_SPAN}) END"""


def _spans_text(spans: str) -> str:
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    return f"array_join(transform({spans}, s -> concat({names}[s.kind], ':', s.start, ':', s.end)), ',')"


def _let(value: str, name: str, out: str) -> str:
    return f"transform(array({value}), {name} -> {out})[0]"


def _unknown() -> str:
    """SQL for all matches of unknown forms, without the punctuation around them; of those that meet base spans,
    the whole words outside of the spans.  ``may``: the kinds a match can be of, as bits."""
    found = f"concat({', '.join(_found('_t', form, when, may, 'true') for may, when, form in _FORMS)})"
    # sorted starts and ends of intervals leave a gap where the next start is beyond an end
    gaps = _let("filter(base, s -> s.start < c.end AND c.start < s.end)", "o", _let(
        "named_struct('a', concat(array(c.start), array_sort(o.end)), 'b', concat(array_sort(o.start), array(c.end)))", "g",
        "transform(sequence(0, size(o)), i -> named_struct('a', g.a[i], 'b', g.b[i], 'c', c))"))
    parts = f"filter(flatten(transform({found}, c -> {gaps})), x -> x.a < x.b)"
    # without the rest of a word that a base span cuts
    whole = f"""transform({parts}, x -> {_let("substring(x.c.value, x.a - x.c.start + 1, x.b - x.a)", "v", _let(
        r"""named_struct('a', CASE WHEN x.a > x.c.start THEN char_length(regexp_extract(v, '^\\S*', 0)) ELSE 0 END,
                         'b', CASE WHEN x.b < x.c.end THEN char_length(regexp_extract(v, '(?<!\\S)\\S*+$', 0)) ELSE 0 END)""",
        "n", """named_struct('may', x.c.kind, 'at', x.a + n.a, 'value', substring(v, n.a + 1, char_length(v) - n.a - n.b),
                'left', right(concat(x.c.left, left(x.c.value, x.a - x.c.start + n.a)), """ + f"{LEFT_CHARS}))"))})"""
    # a bracket stays where it closes, or opens, inside
    head = r"^(?:[^\\p{L}\\p{N}+@(\\[]|[(\\[](?![^()\\[\\]]*+[)\\]]\\s*+[\\p{L}\\p{N}+-])|@(?!KEEP))*+"
    tail = r"(?<![^\\p{L}\\p{N}KEEP])[^\\p{L}\\p{N}KEEP]*+$"
    cut = lambda mail, rest: (f"CASE WHEN w.may = {_MAIL} THEN char_length(regexp_extract(w.value, '{mail}', 0)) "  # noqa: E731
                              f"ELSE char_length(regexp_extract(w.value, '{rest}', 0)) END")
    heads = cut(head.replace("|@(?!KEEP)", ""), head.replace("(?!KEEP)", ""))
    tails = cut(tail.replace("KEEP", "@"), tail.replace("KEEP", ""))
    bare = f"""transform({whole}, w -> {_let(f"named_struct('a', {heads}, 'b', {tails})", "n", _let(
        "substring(w.value, n.a + 1, char_length(w.value) - n.a - n.b + CASE WHEN "
        r"substring(w.value, n.a + 1, char_length(w.value) - n.a - n.b) RLIKE '[(\\[][^()\\[\\]]*+$' "
        r"AND right(w.value, n.b) RLIKE '^[)\\]]' THEN 1 ELSE 0 END)", "v",
        r"named_struct('start', w.at + n.a, 'end', w.at + n.a + char_length(v), 'value', v, "
        rf"'left', regexp_extract(regexp_replace(w.left, {_q(_QUOTES)}, ''), '(?:\\S+\\s+)?\\S+\\s*$', 0), 'may', "
        f"CASE WHEN w.may = {_NUMERIC} AND v RLIKE '(?:[^0-9]*+[0-9]){{4}}' THEN {_MAIL | _NUMERIC} ELSE w.may END)"))})"""
    holds = " ".join(f"WHEN {may} THEN v.value RLIKE {_q(form)}" for may, form in _HOLDS.items())
    return f"filter({bare}, v -> CASE v.may {holds} ELSE true END)"


def _extract(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per row: all base spans in order, and unknown forms outside of them."""
    own = f"[{_CUT}{_JOIN}{_DOT}]"
    texts = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("_text"))
    texts = texts.withColumn("_t", F.regexp_replace("_text", own, _OWN))
    texts = texts.select(
        "doc_id", F.xxhash64("_text", F.lit(1)).alias("_h1"), F.xxhash64("_text", F.lit(2)).alias("_h2"), "_t",
        F.expr("_t RLIKE '[0-9]'").alias("_digits"),
        F.regexp_replace("_t", r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])", _DOT).alias("_dots"),
        F.regexp_replace("_t", "(?<=[0-9])[ -](?=[0-9])", _JOIN).alias("_joined"))
    one = ", ".join(_found(_IN[k], _PATTERNS[k], _IF[k], i, _VALID[k]) for i, k in enumerate(KINDS))
    based = texts.select("doc_id", "_h1", "_h2", "_t", "_digits", F.expr(f"array_sort(concat({one}))").alias("base"))
    return based.select("doc_id", "_h1", "_h2", "base", F.expr(_unknown()).alias("others"))


def _patterns(left: str) -> Column:
    """The last word, and the last two words, of what stands before an instance and the quotes or brackets around it."""
    text = F.regexp_replace(F.lower(F.translate(F.col(left), _DOT + _JOIN, ".-")), _QUOTES, "")
    return F.array_distinct(F.filter(F.array(F.regexp_extract(text, r"(\S+)\s*$", 1),
                                             F.regexp_extract(text, r"(\S+\s+\S+)\s*$", 1)), lambda p: p != ""))


_CAN = "(may & shiftleft(1, kind)) <> 0"


def _learn(edges: DataFrame) -> DataFrame:
    """Patterns of high confidence, ``pattern, kind, confidence``, from ``pattern, value, seed, may``.

    Every step is a partially aggregated sum over the edges, so that a pattern
    with many instances is never gathered in one task.
    """
    edges = written(edges.groupBy("pattern", "value").agg(F.max("seed").alias("seed"), F.bit_or("may").alias("may")),
                    "pii-edges")
    known = edges.filter("seed >= 0").select("value", F.col("seed").alias("kind"), F.lit(1.0).alias("w")).distinct()
    size = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("size"))
    scored = None
    for _ in range(ROUNDS):
        mass = (edges.join(known, "value").groupBy("pattern", "kind")
                .agg(F.sum("w").alias("mass")).filter(F.col("mass") >= SUPPORT))
        scored = written(mass.join(size, "pattern").select("pattern", "kind", (F.col("mass") / F.col("size"))
                                                           .alias("confidence")), "pii-patterns")
        # what the confident patterns of an unknown instance say together
        said = (edges.filter("seed < 0").join(scored.filter(F.col("confidence") >= CONFIDENCE), "pattern")
                .filter(_CAN).groupBy("value", "kind")
                .agg((1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-9)))))).alias("w")))
        seeds = edges.filter("seed >= 0").select("value", F.col("seed").alias("kind"), F.lit(1.0).alias("w")).distinct()
        known = written(seeds.unionByName(said), "pii-known")
    return scored.filter(F.col("confidence") >= CONFIDENCE)


def find_personal_data(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans``, one row per input row.

    ``spans``: ``kind:start:end`` (code points, end exclusive) by start, then kind,
    comma-joined: the base matches and what the patterns add, the longest where
    several forms start.  The counts and ``base_sha256`` are of the base matches
    alone.

    Defined cases: a null text is empty and has no span; rows that repeat id and
    text get the same spans; the control characters used inside stand for
    themselves and match nothing; an empty table gives an empty result; other
    input columns are ignored.
    """
    rows = written(_extract(docs, id_col, text_col), "pii-spans")
    seeds = rows.select(F.explode("base").alias("s")).select(
        _patterns("s.left").alias("patterns"), F.col("s.value").alias("value"), F.col("s.kind").alias("seed"))
    others = rows.select("doc_id", "_h1", "_h2", F.explode("others").alias("s")).select(
        "doc_id", "_h1", "_h2", "s.start", "s.end", "s.may", F.col("s.value").alias("value"),
        _patterns("s.left").alias("patterns"))
    edges = (seeds.select(F.explode("patterns").alias("pattern"), "value", "seed", F.lit(0).alias("may"))
             .unionByName(others.select(F.explode("patterns").alias("pattern"), "value", F.lit(-1).alias("seed"), "may")))
    patterns = _learn(edges)
    added = (others.withColumn("pattern", F.explode("patterns")).join(patterns, "pattern").filter(_CAN)
             .groupBy("doc_id", "_h1", "_h2", "start")
             .agg(F.max(F.struct("end", "confidence", (-F.col("kind")).alias("k"))).alias("best"))
             .groupBy("doc_id", "_h1", "_h2")
             .agg(F.collect_list(F.struct(F.col("start"), (-F.col("best.k")).alias("kind"), F.col("best.end"))).alias("added")))
    added = added.select(F.col("doc_id").alias("_d"), F.col("_h1").alias("_a"), F.col("_h2").alias("_b"), "added")
    base = F.transform("base", lambda s: F.struct(s.getField("start").alias("start"), s.getField("kind").alias("kind"),
                                                  s.getField("end").alias("end")))
    lean = rows.select("doc_id", "_h1", "_h2", base.alias("base"))
    joined = lean.join(added, (F.col("_h1") == F.col("_a")) & (F.col("_h2") == F.col("_b"))
                       & F.col("doc_id").eqNullSafe(F.col("_d")), "left")
    everything = F.array_sort(F.concat("base", F.coalesce("added", F.expr("slice(base, 1, 0)")))).alias("_all")
    counts = [F.expr(f"CAST(size(filter(base, s -> s.kind = {i})) AS BIGINT) AS n_{k}") for i, k in enumerate(KINDS)]
    return (joined.select("doc_id", *counts, F.expr(f"sha2({_spans_text('base')}, 256)").alias("base_sha256"), everything)
            .withColumn("spans", F.expr(_spans_text("_all"))).drop("_all"))
