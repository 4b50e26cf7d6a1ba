"""License scan by a positional index of rare licence words.

Every licence template is indexed by word and position. How many documents hold each
template word is counted over all documents; in a file, the words of a template that
are rarest in the corpus are looked up, one position more than may be out of place,
and each posting votes for the place where the template would start. A place counts
when enough template words stand at their relative positions and every mandatory key
phrase is there. Short declarations must stand word by word; of findings of one label, one
inside another is not listed. Base phrases are templates too: their rarest word is looked up wherever
it stands, and all words must match.

Defined results: null and empty texts have no words, no labels and score 0; rows that
repeat are rows of their own, also in the document counts; an empty table gives no
rows. Texts of any length are scanned whole.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, log

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from reviewlens.llm.common import map_texts, narrow

FIELDS = (
    "n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
    "base_labels string, labels string, score double, spans array<string>"
)

# Phrases and labels of the base rule.
BASE = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Labels of the method: the words of a notice, and phrases it must hold.
TEMPLATES = {
    "apache-2.0": ("licensed under the apache license version 2 0", ("apache license",)),
    "gpl-2.0": (
        "this work is licensed under the gnu general public license version 2",
        ("general public license version 2",),
    ),
    "gpl-3.0": (
        "this work is licensed under the gnu general public license version 3",
        ("general public license version 3",),
    ),
    "lgpl": ("gnu lesser general public license", ("lesser general public license",)),
    "agpl": ("gnu affero general public license", ("affero general public license",)),
    "cc-by-4.0": ("licensed under cc by 4 0", ("cc by 4 0",)),
    "cc-by-sa": ("licensed under cc by sa 4 0", ("cc by sa",)),
    "cc-by-nc": ("licensed under cc by nc 4 0", ("cc by nc",)),
    "cc-by-nd": ("licensed under cc by nd 4 0", ("cc by nd",)),
    "cc0": ("licensed under cc0 1 0 universal", ("cc0",)),
    "mit": (
        "permission is hereby granted free of charge to any person obtaining a copy of "
        "this software and associated documentation files",
        ("permission is hereby granted", "free of charge"),
    ),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification "
        "are permitted provided that the following conditions are met",
        ("redistribution and use", "source and binary forms"),
    ),
    "mpl-2.0": (
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        ("mozilla public license",),
    ),
    "isc": (
        "permission to use copy modify and or distribute this software for any purpose "
        "with or without fee is hereby granted",
        ("permission to use copy modify", "without fee"),
    ),
    "unlicense": (
        "this is free and unencumbered software released into the public domain",
        ("unencumbered software", "public domain"),
    ),
}
# Short declarations: these words must all stand there, one after the other.
DECLARATIONS = {
    "apache-2.0": ("apache license version 2 0", "apache license 2 0", "license identifier apache 2 0"),
    "gpl-2.0": (
        "gnu general public license version 2", "license identifier gpl 2 0", "gnu gpl version 2", "gplv2",
    ),
    "gpl-3.0": (
        "gnu general public license version 3", "license identifier gpl 3 0", "gnu gpl version 3", "gplv3",
    ),
    "lgpl": ("license identifier lgpl", "gnu lgpl", "lgplv2", "lgplv3"),
    "agpl": ("license identifier agpl", "gnu agpl", "agplv3"),
    "cc-by-4.0": (
        "under cc by 4 0", "creative commons attribution 4 0", "license identifier cc by 4 0",
    ),
    "cc-by-sa": ("creative commons attribution sharealike", "license identifier cc by sa"),
    "cc-by-nc": ("creative commons attribution noncommercial", "license identifier cc by nc"),
    "cc-by-nd": ("creative commons attribution noderivatives", "license identifier cc by nd"),
    "cc0": ("license identifier cc0", "creative commons zero"),
    "mit": ("mit license", "license identifier mit"),
    "bsd": ("bsd license", "bsd 2 clause", "bsd 3 clause", "2 clause bsd", "3 clause bsd"),
    "mpl-2.0": (
        "mozilla public license version 2 0", "mozilla public license 2 0", "license identifier mpl 2 0",
    ),
    "isc": ("isc license", "license identifier isc"),
    "unlicense": ("license identifier unlicense",),
}
# Notices that name the version apart from the licence, with their key phrases.
NOTICES = {
    "gpl-2.0": (
        "the gnu general public license as published by the free software foundation "
        "either version 2 of the license or at your option any later version",
        ("gnu general public license", "version 2"),
    ),
    "gpl-3.0": (
        "the gnu general public license as published by the free software foundation "
        "either version 3 of the license or at your option any later version",
        ("gnu general public license", "version 3"),
    ),
}
# Share of template words that must stand in place.
MIN_SHARE = 0.75

_WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: str) -> list[bytes]:
    """Words in UTF-8, A-Z lowered; every other letter stays as it is."""
    return _WORDS.findall(text.encode("utf-8", "surrogatepass").lower())


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[bytes, ...]
    keys: tuple[tuple[bytes, ...], ...]
    base: bool


def _template(label: str, text: str, keys: tuple[str, ...], base: bool) -> Template:
    return Template(label, tuple(words_of(text)), tuple(tuple(words_of(k)) for k in keys), base)


def all_templates(
    base=BASE, templates=TEMPLATES, declarations=DECLARATIONS, notices=NOTICES
) -> list[Template]:
    return [
        *(_template(label, phrase, (), True) for phrase, label in base.items()),
        *(_template(label, text, keys, False) for label, (text, keys) in templates.items()),
        *(_template(label, text, keys, False) for label, (text, keys) in notices.items()),
        *(_template(label, text, (text,), False) for label, texts in declarations.items() for text in texts),
    ]


def _widest(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """(label, first word, words) without those inside another of the same label."""
    out: list[tuple[str, int, int]] = []
    for label, start, size in sorted(spans, key=lambda s: (s[0], s[1], -s[2])):
        if not out or out[-1][0] != label or start + size > out[-1][1] + out[-1][2]:
            out.append((label, start, size))
    return out


def document_counts(rows: DataFrame, vocabulary: set[bytes]) -> tuple[int, dict[bytes, int]]:
    """(documents, word -> documents that hold it) over all rows of (doc_id, text).

    Counted inside the tasks; the driver gets one number per template word.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts[b""] += 1
                counts.update(vocabulary.intersection(words_of(text)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
            names=["word", "n"],
        )

    parts = rows.select("text").mapInArrow(partial, "word binary, n bigint")
    summed = parts.groupBy("word").agg(F.sum("n").alias("n")).collect()
    found = {bytes(r["word"]): r["n"] for r in summed}
    return found.pop(b"", 0), found


class Scanner:
    """The postings of all templates and the rarity of their words."""

    def __init__(self, templates: list[Template], documents: int, counts: dict[bytes, int]):
        self.templates = templates
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for t, template in enumerate(templates):
            for at, word in enumerate(template.words):
                self.postings[word].append((t, at))
        self.idf = {
            w: log((1 + documents) / (1 + counts.get(w, 0))) for w in self.postings
        }
        # Of so many positions whose words a file holds, one is in place wherever MIN_SHARE is.
        self.enough = [len(t.words) - ceil(MIN_SHARE * len(t.words)) + 1 for t in templates]
        # A base phrase is found at every place through its rarest word.
        self.anchor = [
            max(range(len(t.words)), key=lambda i, t=t: (self.idf[t.words[i]], t.words[i]))
            for t in templates
        ]

    def scan(self, text: str) -> tuple:
        """The values of FIELDS for one text."""
        words = words_of(text)
        places: dict[bytes, list[int]] = {}
        for at, word in enumerate(words):
            if word in self.postings:
                places.setdefault(word, []).append(at)
        rarest = sorted(places, key=lambda w: (-self.idf[w], w))
        starts: dict[int, set[int]] = defaultdict(set)
        looked_up: Counter = Counter()
        for word in rarest:
            for t, offset in self.postings[word]:
                template = self.templates[t]
                if template.base:
                    wanted = offset == self.anchor[t]
                else:
                    wanted = looked_up[t] < self.enough[t]
                    looked_up[t] += wanted
                if wanted:
                    starts[t].update(at - offset for at in places[word])
        base: list[tuple[int, str]] = []
        labels: set[str] = set()
        spans: list[tuple[str, int, int]] = []
        score = 0.0
        for t, found in starts.items():
            template = self.templates[t]
            for start in sorted(found):
                share = self._share(words, template, start)
                if template.base:
                    if share == 1.0:
                        base.append((start, template.label))
                elif share >= MIN_SHARE and self._has_keys(words, template, start):
                    labels.add(template.label)
                    spans.append((template.label, max(start, 0), len(template.words)))
                    score = max(score, share)
        base_labels = {label for _, label in base}
        if base:
            score = 1.0
        at = [a for a, _ in base]
        said = [f"{label}:{start}:{size}" for label, start, size in _widest(spans)]
        said += [f"{label}:{a}:0" for a, label in sorted(base)]
        return (
            len(words), len(base), min(at, default=None), max(at, default=None),
            ",".join(sorted(base_labels)), ",".join(sorted(base_labels | labels)), score, said,
        )

    @staticmethod
    def _share(words: list[bytes], template: Template, start: int) -> float:
        inside = range(max(0, -start), min(len(template.words), len(words) - start))
        equal = sum(words[start + i] == template.words[i] for i in inside)
        return equal / len(template.words)

    @staticmethod
    def _has_keys(words: list[bytes], template: Template, start: int) -> bool:
        """Every key phrase stands inside the template's place, give or take two words."""
        window = words[max(0, start - 2) : max(0, start + len(template.words) + 2)]
        for key in template.keys:
            n = len(key)
            if not any(tuple(window[i : i + n]) == key for i in range(len(window) - n + 1)):
                return False
        return True


def scan_licenses(
    docs: DataFrame, key: str = "doc_id", text: str = "text", base=BASE, templates=TEMPLATES,
    declarations=DECLARATIONS, notices=NOTICES,
) -> DataFrame:
    """(doc_id and FIELDS) per row; ``spans`` are label:first word:words of each finding.

    Template words are counted over all documents, by a job, when this is called.
    """
    rows = narrow(docs, key, text)
    known = all_templates(base, templates, declarations, notices)
    counts = document_counts(rows, {w for t in known for w in t.words})

    def make():
        scanner = Scanner(known, *counts)
        return lambda texts: list(zip(*map(scanner.scan, texts)))

    return map_texts(rows, make, FIELDS)
