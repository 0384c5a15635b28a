"""Column expressions for text: distinct lists, paths, template fill, settings lines."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def joined_distinct(values: Column) -> Column:
    """Distinct values of an aggregate group as sorted comma-joined text, null if there are none."""
    return F.nullif(F.array_join(F.array_sort(F.collect_set(values)), ","), F.lit(""))


def browser_name(uid: Column) -> Column:
    """A uid as it appears in browser object names."""
    return F.replace(uid, F.lit("-"), F.lit("_"))


def norm_path(path: Column) -> Column:
    """An absolute path without empty, '.' and '..' parts; exactly two leading slashes are kept."""
    def push(parts: Column, part: Column) -> Column:
        up = F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0)))
        return F.when(part == "..", up).otherwise(F.array_append(parts, part))

    named = F.filter(F.split(path, "/"), lambda p: ~p.isin("", "."))
    resolved = F.array_join(F.aggregate(named, F.array().cast("array<string>"), push), "/")
    return F.concat(F.when(path.rlike("^//([^/]|$)"), "//").otherwise("/"), resolved)


def norm_paths(paths: Column) -> Column:
    """An array of absolute paths, each normalised."""
    return F.transform(paths, norm_path)


def is_plain_name(part: Column) -> Column:
    """Whether text is one path part that normalising leaves alone."""
    return part.rlike("^[^/]+$") & ~part.isin(".", "..")


def decoded(path: Column) -> Column:
    """A path from file metadata without percent escapes."""
    return F.when(F.contains(path, F.lit("%")), F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))).otherwise(path)


def stem(path: Column) -> Column:
    """A file name without its last extension (leading dots do not start an extension)."""
    return F.regexp_replace(path, r"(?<=[^/.])\.[^./]*$", "")


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, "[^/]*$", 0)


def filled_lines(lines: Sequence[str], fields: Mapping[str, Column]) -> Column:
    """Fixed text lines joined by newlines, with ``{name}`` replaced by a column."""
    pieces: list[Column] = []
    for part in re.split(r"(\{\w+\})", "\n".join(lines)):
        if part.startswith("{") and part.endswith("}"):
            pieces.append(fields[part[1:-1]])
        elif part:
            pieces.append(F.lit(part))
    return F.concat(*pieces)


def template_parts(template: Column, names: Sequence[str]) -> Column:
    """A ``{name}`` template with ``{{``/``}}`` escapes as an array of (text, field) in order.

    ``field`` is the position of a placeholder's name in ``names``, null for literal text and -1
    for a name that is not there.
    """
    one_line = F.replace(template, F.lit("\n"), F.lit(" "))
    tokens = F.regexp_extract_all(one_line, F.lit(r"(\{\{|\}\}|\{\w+\}|[^{}]+)"), F.lit(1))
    known = F.array(*[F.lit("{" + n + "}") for n in names])

    def part(token: Column) -> Column:
        is_escape = token.isin("{{", "}}")
        return F.struct(
            F.when(is_escape, F.substring(token, 1, 1)).otherwise(token).alias("text"),
            F.when(token.startswith("{") & ~is_escape, (F.array_position(known, token) - 1).cast("int")).alias("field"),
        )

    return F.transform(tokens, part)


def placeholder_texts(values: Sequence[Column]) -> Column:
    """Placeholder values as an array of text; nulls as the word a template shows for them."""
    return F.array(*[F.coalesce(v.cast("string"), F.lit("None")) for v in values])


def fill_parts(parts: Column, texts: Column) -> Column:
    """Template parts with every placeholder replaced once; filled text is never filled again.

    ``texts`` should be a stored column: it is read for every part. An unknown placeholder gives
    null.
    """
    filled = F.transform(parts, lambda p: F.when(p["field"].isNull(), p["text"]).otherwise(F.get(texts, p["field"])))
    return F.when(~F.exists(parts, lambda p: F.coalesce(p["field"] == -1, F.lit(False))), F.array_join(filled, ""))
