"""Evasion-style text variants.

Draws come from a hash of (row key, position, seed). ``rate=1`` needs no draws and runs on plain
built-ins; other rates gate each character or word.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K
from .hashing import hash_int, position_uniform, uniform


Rate = float | Column


def _always(rate: Rate) -> bool:
    return not isinstance(rate, Column) and rate >= 1


def _as_column(rate: Rate) -> Column:
    return rate if isinstance(rate, Column) else F.lit(float(rate))


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once per row, not once per array element."""
    return F.transform(F.array(value), use)[0]


def _both_cases(table: dict[str, str]) -> tuple[str, str]:
    pairs = [(k, v) for k, v in table.items()]
    pairs += [(k.upper(), v) for k, v in table.items()]
    return "".join(k for k, _ in pairs), "".join(v for _, v in pairs)


def _characters(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda ch: ch != "")


def _words(text: Column) -> Column:
    return F.filter(F.split(F.trim(text), r"\s+"), lambda w: w != "")


def _swap_characters(text: Column, old: str, new: str, rate: Rate, row_hash: Column) -> Column:
    if _always(rate):
        return F.translate(text, old, new)
    row = F.struct(row_hash.alias("hash"), _as_column(rate).alias("rate"))
    return _once(row, lambda r: F.array_join(F.transform(
        F.split(text, ""),  # the empty piece at the end stays empty
        lambda ch, i: F.when(
            position_uniform(r["hash"], i) < r["rate"], F.translate(ch, old, new)).otherwise(ch),
    ), ""))


def _replace_first(text: Column, old: str, new: str) -> Column:
    at = F.instr(text, old)
    return F.when(at > 0, F.overlay(text, F.lit(new), at, F.lit(len(old)))).otherwise(text)


def leetspeak(text: Column, key: Column, rate: Rate = 1.0, seed: int = 0) -> Column:
    old, new = _both_cases(K.LEET)
    return _swap_characters(text, old, new, rate, hash_int(key, "leet", str(seed)))


def symbol_injection(text: Column, key: Column, rate: Rate = 1.0, seed: int = 0) -> Column:
    """One separator per row, put after non-space characters."""
    row_hash = hash_int(key, "symbol", str(seed))
    marks = F.array(*[F.lit(s) for s in K.SEPARATORS])
    mark = F.element_at(marks, (row_hash % len(K.SEPARATORS) + 1).cast("int"))
    if _always(rate):
        return F.regexp_replace(text, F.lit("([^ ])"), F.concat(F.lit("$1"), mark))
    row = F.struct(row_hash.alias("hash"), _as_column(rate).alias("rate"), mark.alias("mark"))
    return _once(row, lambda r: F.array_join(F.transform(
        _characters(text),
        lambda ch, i: F.when(
            (ch != " ") & (position_uniform(r["hash"], i) < r["rate"]), F.concat(ch, r["mark"])
        ).otherwise(ch),
    ), ""))


def ocr_misread(text: Column, key: Column, rate: Rate = 1.0, seed: int = 0) -> Column:
    out = text
    for n, (old, new) in enumerate(K.MISREAD_PAIRS):
        swapped = _replace_first(out, old, new)
        if not _always(rate):
            swapped = F.when(uniform(key, f"pair{n}", str(seed)) < rate, swapped).otherwise(out)
        out = swapped
    old, new = "".join(K.MISREAD_CHARS), "".join(K.MISREAD_CHARS.values())
    return _swap_characters(out, old, new, rate, hash_int(key, "misread", str(seed)))


def homophones(text: Column, key: Column, rate: Rate = 1.0, seed: int = 0) -> Column:
    """Word swaps on the punctuation-free lower form; phonetic pairs at half the rate."""
    table = F.create_map(*[F.lit(x) for kv in K.HOMOPHONES.items() for x in kv])
    punctuation = F.lit(K.WORD_PUNCTUATION)

    def swap(word: Column, i: Column, row: Column) -> Column:
        other = F.element_at(table, F.btrim(F.lower(word), punctuation))
        if not _always(rate):
            other = F.when(position_uniform(row["hash"], i) < row["rate"], other)
        return F.coalesce(other, word)

    row = F.struct(
        hash_int(key, "homophone", str(seed)).alias("hash"), _as_column(rate).alias("rate"))
    out = _once(
        row, lambda r: F.array_join(F.transform(_words(text), lambda w, i: swap(w, i, r)), " "))
    for n, (old, new) in enumerate(K.PHONETIC_PAIRS):
        gate = uniform(key, f"phonetic{n}", str(seed)) < rate * 0.5
        out = F.when(gate, _replace_first(out, old, new)).otherwise(out)
    return out


def near_duplicate(text: Column, key: Column, seed: int = 0) -> Column:
    pick = hash_int(key, "near", str(seed)) % 4
    return (
        F.when(pick == 0, F.concat(text, F.lit("!!!")))
        .when(pick == 1, F.concat(text, F.lit(" ...")))
        .when(pick == 2, F.upper(text))
        .otherwise(F.lower(text))
    )


def structural(text: Column) -> Column:
    """More than four words: swap the halves; otherwise reverse the words."""
    words = _words(text)
    n = F.size(words)
    cut = F.floor(n / 2).cast("int")
    rotated = F.concat(
        F.slice(words, cut + 1, F.greatest(n - cut, F.lit(0))), F.slice(words, F.lit(1), cut)
    )
    return F.array_join(F.when(n > 4, rotated).otherwise(F.reverse(words)), " ")


def variant_type(ladder: tuple, key: Column, medium: str, seed: int = 0) -> Column:
    roll = uniform(key, medium, str(seed))
    out = None
    for bound, name in ladder:
        out = F.when(roll < bound, name) if out is None else out.when(roll < bound, name)
    return out.otherwise(K.LADDER_LAST)


_LADDERS = {"title": K.TITLE_LADDER, "ocr": K.OCR_LADDER, "asr": K.ASR_LADDER}


def variant(
    text: Column, key: Column, medium: str, rate: Rate | None = None, seed: int = 0
) -> Column:
    """struct(text, variant_type) with the medium's own evasion style.

    Without a rate every row draws its own from the style's range.
    """
    kind = variant_type(_LADDERS[medium], key, medium, seed)

    def row_rate(style: str) -> Rate:
        if rate is not None:
            return rate
        low, high = K.RATE_RANGES[style]
        return F.lit(low) + uniform(key, "rate", style, str(seed)) * (high - low)

    styles = {
        "title": (("leetspeak", leetspeak), ("symbol_injection", symbol_injection)),
        "ocr": (("ocr_misread", ocr_misread),),
        "asr": (("asr_homophone", homophones),),
    }
    (first, apply_first), *more = styles[medium]
    changed = F.when(kind == first, apply_first(text, key, row_rate(first), seed))
    for style, apply_style in more:
        changed = changed.when(kind == style, apply_style(text, key, row_rate(style), seed))
    changed = (
        changed
        .when(kind == "near_duplicate", near_duplicate(text, key, seed))
        .when(kind == "structural", structural(text))
        .otherwise(text)
    )
    return F.struct(changed.alias("text"), kind.alias("variant_type"))


def with_gaps(value: Column, key: Column, rate: float, seed: int = 0) -> Column:
    """The value, or NULL at the given rate."""
    return F.when(uniform(key, "gap", str(seed)) >= rate, value)
