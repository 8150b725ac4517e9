"""Text expressions. All are plain Column expressions; none is a Python UDF.

Patterns come from Python-flavoured rules, where ``\\s`` and ``\\d`` are Unicode
classes; the ``(?U)`` flag gives Java the same meaning.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from larder import fixed

_SPACE = r"[\s\x1c-\x1f]"
# The characters of that class one by one.
_SPACES = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_or_blank(c) -> Column:
    """Null becomes the empty string."""
    return F.coalesce(_col(c).cast("string"), F.lit(""))


def trim_ws(c) -> Column:
    """Strip every kind of whitespace, not only blanks. Only the ends are read, so long inner runs cost nothing."""
    return F.btrim(_col(c), F.lit(_SPACES))


def collapse_ws(c) -> Column:
    return F.regexp_replace(_col(c), rf"(?U){_SPACE}+", " ")


def is_blank(c) -> Column:
    return trim_ws(text_or_blank(c)) == ""


def name_key(c) -> Column:
    """Key under which two spellings of a name are the same item."""
    return collapse_ws(trim_ws(F.lower(text_or_blank(c))))


def clean_text(c) -> Column:
    """Collapse whitespace, drop everything but plain text, strip, lower - in this order."""
    plain = F.regexp_replace(collapse_ws(text_or_blank(c)), fixed.NOT_PLAIN_TEXT, "")
    return F.lower(trim_ws(plain))


def strip_measure(c, variant: str = "index") -> Column:
    return F.regexp_replace(_col(c), "(?U)" + fixed.MEASURE_PATTERNS[variant], "")


def split_list(c, separator: str = ",") -> Column:
    """Trimmed non-empty parts of a separated list."""
    parts = F.transform(F.split(text_or_blank(c), separator, -1), trim_ws)
    return F.filter(parts, lambda p: p != "")


def clean_ingredients(c) -> Column:
    """Ingredient names only: measures dropped, lower case, joined by a comma."""
    without = F.regexp_replace(text_or_blank(c), "(?iU)" + fixed.MEASURE_PATTERNS["clean"], "")
    return F.array_join(F.transform(split_list(without, fixed.LIST_SEPARATOR), F.lower), ", ")


def whitespace_tokens(c) -> Column:
    """Lower-case tokens between whitespace; an empty text has none."""
    return F.filter(F.split(F.lower(text_or_blank(c)), rf"(?U){_SPACE}+", -1), lambda t: t != "")


def word_count(c) -> Column:
    return F.size(F.filter(F.split(text_or_blank(c), rf"(?U){_SPACE}+", -1), lambda t: t != "")).cast("long")


# Runs of two or more letters, digits or underscores in any script.
SEARCH_TOKEN = r"[\p{L}\p{N}_]{2,}"


def search_tokens(c) -> Column:
    return F.regexp_extract_all(F.lower(text_or_blank(c)), F.lit(f"({SEARCH_TOKEN})"), F.lit(1))


def search_text(name="name", category="category", ingredients="ingredients", instructions="instructions") -> Column:
    """The text an item is indexed by."""
    return F.concat(
        text_or_blank(name),
        F.lit(". Category: "), text_or_blank(category),
        F.lit(". Ingredients: "), text_or_blank(ingredients),
        F.lit(". "), text_or_blank(instructions),
    )


def cleaned_search_text() -> Column:
    return search_text(ingredients=clean_ingredients("ingredients"), instructions=clean_text("instructions"))


def training_text(name="name", category="category", ingredients="ingredients", instructions="instructions") -> Column:
    """One item as a training example."""
    return F.concat(
        F.lit("Recipe: "), F.coalesce(_col(name), F.lit(fixed.UNNAMED_ITEM)),
        F.lit("\nCategory: "), text_or_blank(category),
        F.lit("\nIngredients: "), text_or_blank(ingredients),
        F.lit("\nInstructions: "), text_or_blank(instructions),
        F.lit("\n" + fixed.END_OF_TEXT),
    )


def ingredients_count(c) -> Column:
    """Commas + 1, so that an empty list counts 1."""
    text = text_or_blank(c)
    return (F.length(text) - F.length(F.replace(text, F.lit(","), F.lit(""))) + 1).cast("long")


def short_label(c, limit: int = 20) -> Column:
    """The first ``limit`` characters, with an ellipsis when something was cut."""
    text = text_or_blank(c)
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit("..."))).otherwise(text)


def preview(c, limit: int = 120) -> Column:
    """The first ``limit`` characters and always an ellipsis."""
    return F.concat(F.substring(text_or_blank(c), 1, limit), F.lit("..."))


def first_lines(c, n: int = fixed.CONTEXT_LINES) -> Column:
    return F.array_join(F.slice(F.split(text_or_blank(c), "\n", -1), 1, n), "\n")


def lexicon_hits(c, keywords: list[str]) -> Column:
    """How many of the keywords occur as a substring of the lower-cased text."""
    text = F.lower(text_or_blank(c))
    hits = F.lit(0)
    for word in keywords:
        hits = hits + F.contains(text, F.lit(word)).cast("int")
    return hits


def lexicon_score(c, keywords: list[str], saturation: float = fixed.LEXICON_SATURATION) -> Column:
    return F.least(lexicon_hits(c, keywords) / F.lit(saturation), F.lit(1.0))


def coverage(available, ingredients) -> Column:
    """Share of the available list found as a substring; 0 for an empty list."""
    listed = F.coalesce(_col(available), F.array().cast("array<string>"))
    text = F.lower(text_or_blank(ingredients))
    found = F.size(F.filter(listed, lambda a: F.contains(text, F.lower(a))))
    return found / F.greatest(F.size(listed), F.lit(1))


def includes_all(required, ingredients) -> Column:
    """Does the text contain every required substring? True for an empty list."""
    listed = F.coalesce(_col(required), F.array().cast("array<string>"))
    text = F.lower(text_or_blank(ingredients))
    return F.forall(listed, lambda m: F.contains(text, F.lower(m)))


def matches_search(term: str, columns: list[str], regex: bool = False) -> Column:
    """Does the term occur in any of the columns, ignoring case? Null never matches."""
    found = F.lit(False)
    for name in columns:
        # A pattern is matched without regard to case; lower-casing it would turn \\D into \\d.
        hit = _col(name).rlike(f"(?iu){term}") if regex else F.contains(F.lower(_col(name)), F.lit(term.lower()))
        found = found | F.coalesce(hit, F.lit(False))
    return found


def content_key(*parts) -> Column:
    """md5 of the parts, separated so that no two part lists share a key."""
    return F.md5(F.concat_ws("\u0001", *[text_or_blank(p) for p in parts]))


def ingredient_request(ingredients) -> Column:
    return F.concat(F.lit(fixed.INGREDIENT_REQUEST_PREFIX), F.array_join(_col(ingredients), ", "))


def generation_prompt(ingredients) -> Column:
    head, tail = fixed.GENERATION_PROMPT
    return F.concat(F.lit(head), F.array_join(_col(ingredients), ", "), F.lit(tail))


def category_request(category="category", ingredients="ingredients") -> Column:
    """A request made from an item: its category and its first ingredient."""
    return F.concat(text_or_blank(category), F.lit(" with "), F.split(text_or_blank(ingredients), ",", -1)[0])


def context_block(fields: dict[str, str] = fixed.CONTEXT_LABELS) -> Column:
    """One retrieved item as labelled lines."""
    return F.concat(*[F.concat(F.lit(label), text_or_blank(name), F.lit("\n")) for label, name in fields.items()])


def answer_prompt(context, request) -> Column:
    return F.concat(
        F.lit(fixed.PROMPT_HEAD), text_or_blank(context),
        F.lit(fixed.PROMPT_REQUEST), text_or_blank(request),
        F.lit(fixed.PROMPT_TAIL),
    )


def template_answer(request, context) -> Column:
    head, tail = fixed.TEMPLATE_HEAD
    return F.concat(
        F.lit(head), text_or_blank(request), F.lit(tail), first_lines(context), F.lit(fixed.TEMPLATE_TAIL)
    )


def html_of(c) -> Column:
    """Escape, then turn bold marks, bullets and line breaks into markup."""
    html = text_or_blank(c)
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        html = F.replace(html, F.lit(char), F.lit(entity))
    html = F.regexp_replace(html, r"(?d)\*\*(.+?)\*\*", "<strong>$1</strong>")
    html = F.regexp_replace(html, r"(?dmU)^[-*]\s+", "&bull; ")
    return F.replace(html, F.lit("\n"), F.lit("<br>"))
