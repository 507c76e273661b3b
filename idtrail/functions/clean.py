"""Column expressions that clean values; all stay inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from idtrail.functions import vocab as V


def null_if(c, spellings=V.MISSING) -> Column:
    """NULL where the value is one of the ``spellings`` of "missing"."""
    c = _col(c)
    return F.when(~c.isin(*spellings), c)


def blank_to_null(c) -> Column:
    """Trimmed text, or NULL where nothing is left."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def is_label(c) -> Column:
    """True for a usable label: not NULL, not blank and not the dash."""
    c = _col(c)
    return F.coalesce((F.trim(c) != "") & (c != "-"), F.lit(False))


def target_or_withdrawn(c, missing=("-", "")) -> Column:
    """The target id, or the withdrawn marker where the source names no target."""
    return F.coalesce(null_if(c, missing), F.lit(V.WITHDRAWN))


def targets_or_status(targets, status) -> Column:
    """The target list, or the status text where the list is empty."""
    return F.coalesce(F.nullif(_col(targets), F.lit("")), _col(status))


def split_list(c, separator: str = "|") -> Column:
    """Non-blank parts of a delimited list; NULL list gives NULL."""
    parts = F.split(_col(c), "\\Q" + separator + "\\E")
    return F.filter(parts, lambda x: F.trim(x) != "")


def triple_id(c) -> Column:
    """First field of ``id|symbol|status``; text without a pipe passes through."""
    return F.substring_index(_col(c), "|", 1)


def triple_symbol(c) -> Column:
    """Middle field of ``id|symbol|status``; text without two pipes passes through."""
    c = _col(c)
    parts = F.split(c, "\\|")
    return F.when(F.size(parts) >= 3, F.element_at(parts, -2)).otherwise(c)


def triple_status(c) -> Column:
    """Last field of ``id|symbol|status``; text without a pipe passes through."""
    return F.substring_index(_col(c), "|", -1)


def rdf_term(c, iri: str = V.ENTITY_IRI) -> Column:
    """Bare value of an RDF term: no entity IRI, angle brackets, literal quotes or language tag."""
    c = F.replace(_col(c), F.lit("<" + iri), F.lit(""))
    c = F.regexp_replace(c, "[<>]|@en\\b", "")
    return F.regexp_replace(c, '^"|"$', "")


def without_blanks(c) -> Column:
    return F.replace(_col(c), F.lit(" "), F.lit(""))


def fasta_accession(c) -> Column:
    """Accession between the first two pipes of a header line; NULL for other lines."""
    return F.nullif(F.regexp_extract(_col(c), r"^>.*?\|(.*?)\|", 1), F.lit(""))


def release_note(release: str) -> Column:
    return F.lit(f"{V.RELEASE_PREFIX}{release}.")


def without_release(c, ending: str = "") -> Column:
    """Comment text cut before its release note."""
    return F.regexp_replace(_col(c), "(?s) Release.*", ending)


def join_text(*cols, separator: str = " ") -> Column:
    """The non-NULL texts joined by ``separator``; NULL where none is left."""
    return F.nullif(F.concat_ws(separator, *map(_col, cols)), F.lit(""))


def date_stamp(c, pattern: str = "yyyyMMdd") -> Column:
    return F.date_format(_col(c), pattern)


def one_line(c) -> Column:
    """Text with tabs and line ends turned into blanks, so that a row stays one line."""
    return F.translate(_col(c), "\t\n\r", "   ")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c
