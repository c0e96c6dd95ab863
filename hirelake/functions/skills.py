"""Dictionary matching: which terms of a dictionary does a text mention?

A match has to begin and end at a word edge, with "+" and "#" counted as word
characters and a dot before a letter as part of the word. So any match begins
with a whole word of the text, out of a list known per dictionary entry. Each
text is split into words once; entries that are plain words are decided by that
alone, and the pattern of any other entry runs only on texts that hold one of
its first words, and there, if it cannot match beyond a sentence, only on the
sentences that hold a first word of any entry.
"""

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.functions import fixed
from hirelake.functions.text import WORD, literal_array, sql_literal

EDGE_LEFT, EDGE_RIGHT = (edge.replace(r"\w", WORD) for edge in (fixed.SKILL_NOT_BEFORE, fixed.SKILL_NOT_AFTER))

# A word, with the dot if the dot joins it to another word ("node." in "node.js").
_WORDS = rf"[{WORD}+#]++(?:\.(?=[{WORD}]))?"

# Where a sentence ends. It is put back as ". ", which a pattern that stays within a sentence cannot tell from it.
_SENTENCE_END = r"[.;:!?]\s"

# Other letters that match these when case is ignored.
_ALSO = {"s": "ſ", "k": "\u212a", "i": "İı"}


@dataclass(frozen=True)
class Entry:
    name: str
    category: str
    pattern: str
    case_sensitive: bool = False
    first_words: tuple[str, ...] = ()  # empty: the pattern runs on every text

    @property
    def regex(self) -> str:
        flags = "(?U)" if self.case_sensitive else "(?iuU)"
        return f"{self._first_letter}{flags}{EDGE_LEFT}(?:{self.pattern}){EDGE_RIGHT}"

    @property
    def _first_letter(self) -> str:
        """A look at the next letter, far cheaper than the edge check it comes before."""
        if not self.first_words:
            return ""
        letters = {c for w in self.first_words for c in (w[0], w[0].upper(), *_ALSO.get(w[0], ""))}
        return f"(?=[.{''.join(sorted(letters))}])"

    @property
    def in_sentence(self) -> bool:
        """Nothing in the pattern can match, or look at, the end of a sentence: no wild card or excluded class, no sign that ends
        one, and a dot only where a letter follows it. A pattern this cannot be told of runs on the whole text."""
        bare = re.sub(r"\(\?(?:[a-z]*:|<?[=!])", "(", self.pattern)
        return bool(self.first_words) and not re.search(r"\\[^.\-sbw+()]|\[\^|[;:!]|\\\.(?!\??[A-Za-z])|(?<!\\)\.", bare)

    @property
    def plain_words(self) -> list[str]:
        """Whole words that decide the entry by themselves, when that is all it is."""
        words = [w.replace("\\+", "+") for w in self.pattern.split("|")]
        simple = all(re.fullmatch(r"[a-z0-9][a-z0-9+#]*", w) for w in words)
        return words if simple and not self.case_sensitive else []


def _load_entries() -> list[Entry]:
    first = dict(line.split(": ") for line in fixed.SKILL_FIRST_WORDS.split("\n"))
    entries = []
    for line in fixed.SKILL_TABLE.split("\n"):
        name, category, pattern = line.split(" :: ")
        if name in first:
            words = first[name].split()
        else:  # alternatives of literal words: each begins with its first word
            words = [re.match(r"[a-z0-9+#]+", alt.replace("\\+", "+")).group() for alt in pattern.split("|")]
        entries.append(Entry(name, category, pattern, name in fixed.CASE_SENSITIVE_SKILLS, tuple(words)))
    return entries


SKILLS = _load_entries()
SKILL_NAMES = [e.name for e in SKILLS]


#: How marks are spelled out in column names; any other run of signs is one underscore.
SPELLED = {"++": " plus plus ", "#": " sharp ", ".": " dot "}


def skill_slug(name: str) -> str:
    """Column-safe name: "C++" -> "skill_c_plus_plus"."""
    for mark, word in SPELLED.items():
        name = name.replace(mark, word)
    return "_".join(["skill", *re.findall("[a-z0-9]+", name.lower())])


def skill_slug_column(name: Column) -> Column:
    for mark, word in SPELLED.items():
        name = F.replace(name, F.lit(mark), F.lit(word))
    return F.concat_ws("_", F.lit("skill"), F.regexp_extract_all(F.lower(name), F.lit("([a-z0-9]+)"), F.lit(1)))


def _text_words(text: Column) -> Column:
    # The four letters that match an ASCII letter when case is ignored; few texts have any.
    special = F.lit(False)
    for letter in "İıſK":
        special = special | F.contains(text, F.lit(letter))
    folded = F.lower(F.when(special, F.translate(text, "İıſK", "iisk")).otherwise(text))
    return F.regexp_extract_all(folded, F.lit(_WORDS), F.lit(0))


def with_skill_ids(df: DataFrame, text: str, out: str = "skill_ids", entries: list[Entry] = SKILLS) -> DataFrame:
    """Add the sorted positions of the dictionary entries a text mentions."""
    by_word: dict[str, list[int]] = {}
    by_pattern = []
    known = set()
    for i, e in enumerate(entries):
        if e.plain_words:
            for w in e.plain_words:
                by_word.setdefault(w, []).append(i)
        else:
            by_pattern.append((i, e))
            known.update(e.first_words)
            known.update(w + "." for w in e.first_words)
    known.update(by_word)

    none = "cast(array() AS array<int>)"
    pairs = ", ".join(f"{sql_literal(w)}, {sql_literal(ids)}" for w, ids in by_word.items())
    decided = f"flatten(transform(_words, w -> coalesce(map({pairs})[w], {none})))" if by_word else none
    checks = []
    for i, e in by_pattern:
        firsts = [v for w in e.first_words for v in (w, w + ".")]
        guard = f"arrays_overlap(_words, {sql_literal(firsts)}) AND " if firsts else ""
        where = "_found" if e.in_sentence else text
        checks.append(f"CASE WHEN {guard}rlike({where}, {sql_literal(e.regex)}) THEN {i} END")
    # Only sentences with a known word are kept: their words decide the plain entries, and they are what most patterns run on.
    matched = f"array_compact(array({', '.join(checks)}))" if checks else none
    found = f"array_sort(array_distinct(concat({decided}, {matched})))"
    if all(e.first_words for _, e in by_pattern):
        found = f"CASE WHEN size(_words) > 0 THEN {found} ELSE {none} END"
    def with_words(sentence: Column) -> Column:
        words = F.filter(_text_words(sentence), lambda w: w.isin(sorted(known)))
        return F.struct(sentence.alias("text"), words.alias("words"))

    sentences = F.transform(F.split(F.coalesce(F.col(text), F.lit("")), _SENTENCE_END), with_words)
    return (
        df.withColumn("_hits", F.filter(sentences, lambda s: F.size(s["words"]) > 0))
        .withColumns({"_words": F.array_distinct(F.flatten("_hits.words")), "_found": F.concat_ws(". ", "_hits.text")})
        .withColumn(out, F.expr(f"coalesce({found}, {none})"))
        .drop("_hits", "_words", "_found")
    )


def skill_names(ids, entries: list[Entry] = SKILLS) -> Column:
    """Names for an array of positions, in dictionary order."""
    ids = F.col(ids) if isinstance(ids, str) else ids
    return F.transform(ids, lambda i: F.element_at(literal_array(e.name for e in entries), i + 1))


def skill_name(skill_id, entries: list[Entry] = SKILLS) -> Column:
    skill_id = F.col(skill_id) if isinstance(skill_id, str) else skill_id
    return F.element_at(literal_array(e.name for e in entries), skill_id + 1)


def skill_category(skill_id, entries: list[Entry] = SKILLS) -> Column:
    skill_id = F.col(skill_id) if isinstance(skill_id, str) else skill_id
    return F.element_at(literal_array(e.category for e in entries), skill_id + 1)


def skill_flags(ids: str, entries: list[Entry] = SKILLS) -> list[Column]:
    """One 0/1 column per dictionary entry."""
    return [F.array_contains(ids, i).cast("int").alias(skill_slug(e.name)) for i, e in enumerate(entries)]
