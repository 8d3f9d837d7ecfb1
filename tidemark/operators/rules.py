"""Ordered rules as single CASE expressions: the first rule that holds decides."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import fixed_values as V
from tidemark.functions import text as T


def first_match(rules: Iterable[tuple[Column, Column | str | None]], default: Column | None = None) -> Column:
    """The value of the first rule whose condition is true."""
    out = None
    for condition, value in rules:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return out.otherwise(default) if default is not None else out


def _said(message: str, value: Column) -> Column:
    head, _, tail = message.partition("{}")
    return F.concat(F.lit(head), value, F.lit(tail))


def word_fault(
    source: Column,
    gloss: Column,
    part_of_speech: Column,
    verb_particles: Sequence[str] = V.VERB_PARTICLES,
    noun_particles: Sequence[str] = V.NOUN_PARTICLES,
    negations: Sequence[str] = V.NEGATIONS,
    leaks: Sequence[str] = V.DICTIONARY_LEAKS,
    foreign: str = V.FOREIGN_SCRIPTS,
) -> Column:
    """The number of the first fault of a word's trimmed gloss, or null. A null part of speech is ''; a digits-only source passes."""
    text, pos = gloss, F.coalesce(part_of_speech, F.lit(""))
    negative = pos.contains("Negative") | pos.contains("Prohibition")
    negated = reduce(lambda a, b: a | b, [text.contains(n) for n in negations])
    leaked = reduce(lambda a, b: a | b, [text.contains(n) for n in leaks])
    faults = (
        text.rlike(foreign),
        text.contains("/"),
        pos.contains("Verb") & text.isin(list(verb_particles)),
        pos.contains("Noun") & ~pos.contains("Verbal") & text.isin(list(noun_particles)),
        negative & ~negated,
        (text.contains("(") | text.contains(")")) & (T.count_char(text, "(") != T.count_char(text, ")")),
        F.length(text) <= 1,
        leaked,
    )
    letters_first = (source >= ":") & (source < "\x80")  # most words: neither a digit nor white space begins them
    digits = ~letters_first & source.rlike(f"^{T.WS}*{V.DIGITS_ONLY.strip('^$')}{T.WS}*\\z")
    return first_match([(digits, F.lit(None).cast("int")), *[(fault, F.lit(i)) for i, fault in enumerate(faults)]])


def fault_message(number: Column, gloss: Column, messages: Sequence[str] = V.WORD_MESSAGES) -> Column:
    """The message of a fault by its number; null without one."""
    parts = [m.partition("{}") for m in messages]
    head, tail = (F.get(F.array(*[F.lit(p[i]) for p in parts]), number) for i in (0, 2))
    return F.concat(head, gloss, tail)


def fault_head(number: Column, messages: Sequence[str] = V.WORD_MESSAGES) -> Column:
    """What a fault's message says before it quotes the gloss."""
    return F.get(F.array(*[F.lit(m.split("'")[0]) for m in messages]), number)


def word_rule(source: Column, gloss: Column, part_of_speech: Column, **tables) -> Column:
    """The message of the first fault of a word's gloss, or null. A null gloss is ''."""
    text = T.trim_ws(F.coalesce(gloss, F.lit("")))
    return fault_message(word_fault(source, text, part_of_speech, **tables), text)


def decision(answer: Column) -> Column:
    """A reviewer's free text as approve, reject, custom or skip."""
    given = T.trim_ws(F.coalesce(answer, F.lit("")))
    return first_match([(given == "", "skip"), (F.upper(given).isin(list(V.APPROVALS)), "approve"), (F.upper(given).isin(list(V.REFUSALS)), "reject")], F.lit("custom"))


def placement_tier(letter_delta: Column, pct_delta: Column, ratio: Column) -> Column:
    return first_match(
        [
            (letter_delta <= 3, V.PLACED_WELL),
            ((letter_delta <= 7) | ((pct_delta <= 2.5) & (ratio >= 0.70)), V.PLACED_LIKELY),
            ((letter_delta <= 15) & (pct_delta <= 5.0), V.PLACED_REVIEW),
        ],
        F.lit(V.PLACED_ADRIFT),
    )


def removed_notes(before: Column, after: Column) -> Column:
    """Distinct (bracketed) notes of ``before`` that ``after`` lacks."""
    pattern = F.lit(r"\([^)]*\)")
    return F.array_except(F.regexp_extract_all(before, pattern, F.lit(0)), F.regexp_extract_all(after, pattern, F.lit(0)))


def spacing_only(target: Column, replacement: Column) -> Column:
    """Whether an edit moves white space only; null phrases are ''."""
    return T.strip_ws(F.coalesce(target, F.lit(""))) == T.strip_ws(F.coalesce(replacement, F.lit("")))


def guard_edit(original: Column, target: Column, replacement: Column, issue_type: Column) -> Column:
    """Struct (ok, text, status): whether an edit keeps the text's invariants; a rejected one keeps the original."""
    target, replacement = F.coalesce(target, F.lit("")), F.coalesce(replacement, F.lit(""))
    issue_type = F.coalesce(issue_type, F.lit("TYPO"))
    edited = T.replace_first(original, target, replacement)
    edited = F.when(target == "", F.concat(replacement, original)).otherwise(edited)
    removed = F.when(F.contains(original, F.lit("(")), F.array_sort(removed_notes(original, edited))).otherwise(F.array().cast("array<string>"))
    delta = F.length(edited) - F.length(original)
    status = first_match(
        [
            (spacing_only(target, replacement), V.PURE_SPACING),
            (~F.contains(original, target), _said(V.NOT_VERBATIM, target)),
            (F.size(removed) > 0, _said(V.NOTE_REMOVED, F.concat(F.lit("{'"), F.array_join(removed, "', '"), F.lit("'}")))),
            ((issue_type == "TYPO") & (F.abs(delta) > 15), _said(V.TYPO_TOO_LONG, delta.cast("string"))),
            ((issue_type == "MISTRANSLATION") & (delta < -50), _said(V.SHRUNK, F.abs(delta).cast("string"))),
        ],
        F.lit(V.PASSED),
    )
    ok = status == V.PASSED
    return F.struct(ok.alias("ok"), F.when(ok, edited).otherwise(original).alias("text"), status.alias("status"))


def spacing_verdict(original: Column, spaced: Column, final: Column) -> Column:
    """Struct (ok, text, status): an edit may change spacing only; ``final`` is ``spaced`` after mechanical spacing.

    Texts are compared in normal form C, without white space.
    """
    from tidemark.functions.kernels import same_letters

    # where mechanical spacing changed nothing, its text need not be compared a second time
    same = same_letters(original, spaced, F.when(final.eqNullSafe(spaced), F.lit(None).cast("string")).otherwise(final))
    kept = F.coalesce(same[0], F.lit(False))
    status = first_match(
        [
            (~kept, V.CHARACTER_MISMATCH),
            (~final.eqNullSafe(spaced) & ~F.coalesce(same[1], F.lit(False)), V.POST_PROCESS_MISMATCH),
            (final != original, V.SPACING_CHANGED),
        ],
        F.lit(V.SPACING_CLEAN),
    )
    ok = status.isin(V.SPACING_CHANGED, V.SPACING_CLEAN)
    return F.struct(ok.alias("ok"), F.when(ok, final).otherwise(original).alias("text"), status.alias("status"))


def spacing_lock(original: Column, spaced: Column) -> Column:
    """:func:`spacing_verdict` of an edit as it comes; :func:`lock_spacing` prepares the edit's text once for a whole table."""
    return spacing_verdict(original, spaced, T.mechanical_spacing(spaced))


def lock_spacing(df: DataFrame, original: Column, spaced: Column, name: str = "lock") -> DataFrame:
    """``df`` with a struct column ``name`` (ok, text, status)."""
    held = df.withColumns({"__original": original, "__spaced": spaced})
    held = held.withColumn("__final", T.mechanical_spacing(F.col("__spaced")))
    return held.withColumn(name, spacing_verdict(F.col("__original"), F.col("__spaced"), F.col("__final"))).drop("__original", "__spaced", "__final")


def rework_needed(mode: str, processed: Column, status: Column, prompt_version: Column, current: str, key: Column | None = None) -> Column:
    """Whether a text needs another pass: '', 'rejected', 'both', 'optimized', 'all', or a comma-separated list of keys."""
    status, done = F.coalesce(status, F.lit("")), F.coalesce(processed, F.lit(False))
    rejected, stale = status.contains("REJECTED"), ~F.coalesce(prompt_version == current, F.lit(False))
    optimized = status == V.SPACING_CHANGED
    if mode in ("rejected", "mismatches"):
        return rejected
    if mode in ("both", "targets", "yes", "true"):
        return stale & (optimized | rejected)
    if mode == "optimized":
        return stale & optimized
    if mode == "all":
        return ~done | (stale & (optimized | rejected))
    if ":" in mode:
        return key.isin(mode.split(","))
    return ~done
