"""Codes: ``SAB:id`` strings made from the many spellings that sources use."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from vocabweave.functions.fixed_values import (
    HASH_PREFIX_SOURCES,
    PREFIX_SOURCES,
    UNDERSCORE_PREFIX_SOURCES,
)


def after_last(text: Column, mark: str) -> Column:
    return F.substring_index(text, mark, -1)


@dataclass(frozen=True)
class Tail:
    """Text that contains ``marker`` becomes ``sab:`` + what follows the last ``mark``."""

    marker: str
    sab: str
    mark: str
    any_case: bool = False
    blanks: str = " "

    def applies(self, raw: Column) -> Column:
        return (F.upper(raw) if self.any_case else raw).contains(self.marker)

    def value(self, raw: Column) -> Column:
        text = raw if self.blanks == " " else F.replace(raw, F.lit(" "), F.lit(self.blanks))
        return F.concat(F.lit(self.sab + ":"), after_last(text, self.mark))


@dataclass(frozen=True)
class Respell:
    """Text that contains ``marker`` keeps its form but for some replaced pieces."""

    marker: str
    pieces: tuple

    def applies(self, raw: Column) -> Column:
        return raw.contains(self.marker)

    def value(self, raw: Column) -> Column:
        for old, new in self.pieces:
            raw = F.replace(raw, F.lit(old), F.lit(new))
        return raw


# Special spellings, in order; the last one that applies wins.
SPELLINGS_BEFORE_PREFIXES = [
    Tail("Thesaurus.owl", "NCI", "#"),
    Tail("EDAM", "EDAM", ":"),
    Tail("edam", "EDAM", "/", blanks="_"),
    Tail("http://identifiers.org/hgnc", "HGNC", "/"),
    Tail("http://purl.obolibrary.org/obo/mondo#", "MONDO", "#"),
    Respell("REFSEQ", (("REFSEQ ", "REFSEQ:"), (" ", "_"))),
    Respell("MSIGDB", (("MSIGDB ", "MSIGDB:"), (" ", "_"))),
    Respell("REACTOME", (("REACTOME ", "REACTOME:"), (" ", "_"))),
    Tail("https://repo.metadatacenter.org/templates/", "CEDAR", "/"),
    Tail("https://repo.metadatacenter.org/template-fields/", "CEDAR", "/"),
    Tail("https://schema.metadatacenter.org/core/", "CEDAR", "/"),
    Tail("http://www.w3.org/2001/XMLSchema", "XSD", "#"),
    Tail("https://purl.humanatlas.io/vocab/hravs#", "HRAVS", "_"),
    Tail("HRAVS HRAVS", "HRAVS", " ", any_case=True),
    Tail("http://dicom.nema.org/resources/ontology/DCM/", "DCM", "/"),
    Tail("http://purl.bioontology.org/ontology/LNC", "LNC", "/"),
    Tail("http://www.orpha.net/ORDO/", "ORDO", "_"),
]
SPELLINGS_AFTER_PREFIXES = [
    Tail("uniprot.org", "UNIPROT", "/"),
    Respell("HGNC HGNC:", (("HGNC HGNC:", "HGNC:"),)),
    Respell("HPO HP:", (("HPO HP:", "HP:"),)),
    Respell("HCOP HCOP:", (("HCOP HCOP:", "HCOP:"),)),
    Respell("NCBI Gene", (("NCBI Gene", "ENTREZ:"),)),
    Respell("GENCODE_VS", (("GENCODE:VS", "GENCODE_VS"),)),
    Respell("SENOTYPE_VS", (("SENOTYPE:VS", "SENOTYPE_VS"),)),
]

# Pieces rewritten in the plain form, in order.
PLAIN_PIECES = [("NCIT ", "NCI:"), ("MESH ", "MSH:"), ("NCBITaxon ", "NCBI:")]
PLAIN_PATTERNS = [("UMLS", r".*UMLS.*\s", "UMLS:"), ("SNOMED", r".*SNOMED.*\s", "SNOMEDCT_US:"), ("fma", r"^fma ?", "FMA:")]
LATE_PIECES = [("Hugo.owl HGNC ", "HGNC:"), ("gene symbol report?hgnc id=", "HGNC:")]


def _plain_form(raw: Column) -> Column:
    """Last path piece with blanks for delimiters; patterns only run on text that holds their word."""
    text = after_last(F.translate(raw, ":#_", "   "), "/")
    for old, new in PLAIN_PIECES:
        text = F.replace(text, F.lit(old), F.lit(new))
    rewritten, holds_word = text, F.lit(False)
    for word, pattern, new in PLAIN_PATTERNS:
        rewritten = F.regexp_replace(rewritten, pattern, new)
        holds_word = holds_word | raw.contains(word)
    text = F.when(holds_word, rewritten).otherwise(text)
    for old, new in LATE_PIECES:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def pair_literal(pairs: list[tuple[str, str]]) -> Column:
    """A constant array of (key, value) structs, folded before the query runs."""
    rows = json.dumps([{"key": key, "value": value} for key, value in pairs])
    return F.from_json(F.lit(rows), "array<struct<key:string,value:string>>")


def prefix_source(raw: Column) -> Column:
    """Source of the last prefix in the map that ``raw`` contains, else null."""
    hits = F.filter(pair_literal(PREFIX_SOURCES), lambda pair: F.contains(raw, pair["key"]))
    return F.try_element_at(hits, F.lit(-1))["value"]


def standardize_code(raw: Column, sab: Column | str = "", as_coded: bool = False, prefix: Column | None = None) -> Column:
    """``SAB:id`` form of a code or cross-reference of source ``sab``; null stays null.

    One CASE over the raw text, latest rule first. ``as_coded`` keeps two oddities of the
    original results: EDAM cross-references lose their SAB, and any blank-free text that
    starts with C counts as a UMLS concept (by default its second character must be a digit).
    ``prefix`` is the source that a map names, where it is not the map kept here.
    """
    rules = [(rule.applies(raw), rule.value(raw)) for rule in SPELLINGS_BEFORE_PREFIXES]
    if as_coded:
        rules[1] = (rules[1][0], after_last(raw, ":"))
    source = F.lit(sab) if isinstance(sab, str) else sab
    if not isinstance(sab, str) or sab in HASH_PREFIX_SOURCES + UNDERSCORE_PREFIX_SOURCES:
        mapped = prefix_source(raw) if prefix is None else prefix
        rules.append((
            source.isin(HASH_PREFIX_SOURCES) & mapped.isNotNull(),
            F.concat(mapped, F.lit(":"), after_last(F.translate(raw, " /", "__"), "#")),
        ))
        rules.append((
            source.isin(UNDERSCORE_PREFIX_SOURCES) & mapped.isNotNull(),
            F.concat(mapped, F.lit(":"), after_last(F.translate(raw, " /=", "___"), "_")),
        ))
    rules += [(rule.applies(raw), rule.value(raw)) for rule in SPELLINGS_AFTER_PREFIXES]

    (condition, value), *earlier = reversed(rules)
    chosen = F.when(condition, value)
    for condition, value in earlier:
        chosen = chosen.when(condition, value)
    chosen = chosen.otherwise(_plain_form(raw))

    # every use of the chosen text is the same expression, which Spark evaluates once per row;
    # a lambda that names it would leave the whole CASE to interpreted evaluation
    return _finish(chosen, as_coded)


def _finish(value: Column, as_coded: bool) -> Column:
    """Text before the first blank is the SAB; blank-free ``C1...`` is a UMLS concept."""
    head = F.substring_index(value, " ", 1)
    rest = value.substr(F.length(head) + 2, F.length(value))
    bare = value.startswith("C") & ~value.contains("CEDAR")
    if not as_coded:
        bare = bare & value.rlike("^C[0-9]")
    return (
        F.when(value.contains(" "), F.concat(F.upper(head), F.lit(":"), rest))
        .when(bare, F.concat(F.lit("UMLS:"), value))
        .otherwise(value)
    )


def standardize_dbxref(raw: Column, as_coded: bool = False) -> Column:
    """Standard code of a cross-reference; its source is its own prefix as written."""
    return standardize_code(raw, sab_of_code(raw), as_coded)


def sab_of_code(code: Column) -> Column:
    return F.substring_index(code, ":", 1)


def iri_to_curie(iri: Column) -> Column:
    """Last path piece with its underscores as colons."""
    return F.replace(after_last(iri, "/"), F.lit("_"), F.lit(":"))


def iri_namespace(iri: Column) -> Column:
    """Upper-case lead of an underscored last path piece, else the host."""
    last = after_last(iri, "/")
    lead = F.upper(F.regexp_extract(last, r"^(.*?)(?:\W|_)", 1))
    return F.when(last.contains("_"), lead).otherwise(F.get(F.split(iri, "/"), F.lit(2)))


def clean_concept_id(cui: Column) -> Column:
    """Concept ids spelled ``SAB:CUI id`` lose the inner word."""
    return F.replace(cui, F.lit(":CUI "), F.lit(":"))


def strip_version(accession: Column) -> Column:
    return F.split_part(accession, F.lit("."), F.lit(1))


def version_of(accession: Column) -> Column:
    return F.split_part(accession, F.lit("."), F.lit(2))


def text_id(text: Column, sab: str = "ENTREZ") -> Column:
    """URL-safe base64 id of a definition text, without line breaks."""
    body = F.concat(F.lit(sab + " "), text, F.lit(" CUI"))
    return F.translate(F.base64(F.encode(body, "UTF-8")), "+/\r\n", "-_")


def numbered_id(parent: int, number: Column, room: int) -> Column:
    """``parent`` + ``number``; an error where the number would run into the next parent's range."""
    message = F.concat(F.lit(f"more than {room - 1} ids below {parent}: give the parents wider ranges, not "), number.cast("string"))
    return F.lit(parent) + F.when(number < room, number).otherwise(F.raise_error(message))


def rooms(parents: list[int]) -> dict[int, int]:
    """Ids from each parent up to the next higher one; the highest has no bound."""
    ordered = sorted(set(parents))
    return {a: b - a for a, b in zip(ordered, [*ordered[1:], 1 << 62])}
