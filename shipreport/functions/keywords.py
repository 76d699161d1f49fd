"""Many keywords looked for in one pass over a text, as built-in expressions.

The words become one pattern: a trie, longest word first, inside a look-ahead, so that words that
overlap or lie inside each other are all met. At each place of the text the pattern gives
the longest word that begins there; every other word that begins there is a beginning of it,
which is known beforehand. Each letter of the text is looked at once for each level of the
trie it can be on, however many words there are.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Rules = Sequence[tuple[str, str]]


def trie_pattern(words: Iterable[str]) -> str:
    """A pattern, with one group, that matches before each place where a word begins, the longest one in the group."""
    root: dict = {}
    for word in words:
        node = root
        for letter in word:
            node = node.setdefault(letter, {})
        node[""] = {}

    def written(node: dict) -> str:
        branches = []
        for letter, child in sorted((k, v) for k, v in node.items() if k):
            text = re.escape(letter)
            while len(child) == 1 and "" not in child:  # a stretch without branches
                (letter, child), = child.items()
                text += re.escape(letter)
            branches.append(text + written(child))
        if not branches:
            return ""
        if len(branches) == 1 and "" not in node:
            return branches[0]
        return f"(?:{'|'.join(branches)}){'?' if '' in node else ''}"

    # What cannot begin a word is passed over by a class of letters, not branch by branch.
    first = "".join(sorted({re.escape(k) for k in root}))
    return f"(?=[{first}])(?=({written(root)}))"


def words_in(content: Column, words: Iterable[str]) -> Column:
    """The distinct ``words`` that occur in a text, in no order; NULL for a NULL text.

    Letter case counts. A word that is empty is refused.
    """
    words = sorted(set(words))
    if "" in words:
        raise ValueError("an empty keyword")
    if not words:
        return F.when(content.isNotNull(), F.array().cast("array<string>"))
    found = F.array_distinct(F.regexp_extract_all(content, F.lit(trie_pattern(words)), F.lit(1)))
    known, holding = set(words), {}
    for word in words:
        own = [word[:n] for n in range(1, len(word)) if word[:n] in known]
        if own:
            holding[word] = [*own, word]
    if not holding:
        return found
    expanded = F.transform(found, lambda w: F.coalesce(_mapped(holding, "array<string>")[w], F.array(w)))
    return F.array_distinct(F.flatten(expanded))


def _mapped(values: Mapping[str, object], kind: str) -> Column:
    keys, of = list(values), list(values.values())
    lists = F.array(*[F.array(*map(F.lit, v)) if isinstance(v, list) else F.lit(v) for v in of])
    return F.map_from_arrays(F.array(*map(F.lit, keys)), lists.cast(f"array<{kind}>"))


def deciding(rules: Rules) -> list[tuple[int, str]]:
    """The rules (number, word) that can be the first to match.

    A word that holds an earlier rule's word never decides, nor does one after an empty word, which
    every text holds.
    """
    longest, seen, out = max((len(w) for w, _ in rules), default=0), set(), []
    for number, (word, _) in enumerate(rules):
        parts = {word[a:b] for a in range(len(word)) for b in range(a + 1, min(len(word), a + longest) + 1)}
        if not parts & seen and not (word and "" in seen):
            out.append((number, word))
        seen.add(word)
        if not word:
            break
    return out


def first_rule(content: Column, rules: Rules) -> Column:
    """The number, from 0, of the first rule whose word occurs in a text, in one pass; NULL if none does."""
    chosen = deciding(rules)
    always = next((n for n, word in chosen if not word), None)
    numbers = {word: n for n, word in chosen if word}
    # Of the words that begin at one place, a longer one has the smaller number here: it would
    # not decide otherwise. So the longest says all.
    rest = F.when(content.isNotNull(), F.lit(always)) if always is not None else F.lit(None).cast("int")
    if not numbers:
        return rest.cast("int")
    found = F.array_distinct(F.regexp_extract_all(content, F.lit(trie_pattern(numbers)), F.lit(1)))
    least = F.array_min(F.transform(found, lambda w: _mapped(numbers, "int")[w]))
    return F.coalesce(least, rest.cast("int"))


def first_label(content: Column, rules: Rules, default: str | None = None) -> Column:
    """The label of the first rule whose word occurs in a text, in one pass."""
    if not rules:
        return F.lit(default).cast("string")
    labels = F.array(*[F.lit(label) for _, label in rules])
    return F.coalesce(F.get(labels, first_rule(content, rules)), F.lit(default).cast("string"))
