"""Licences named in texts, by rules over sentences.

Texts are cut into sentences at full stops and line breaks, and a rule may also reach over single line breaks
(with comment marks) of a wrapped sentence. Sentences are normalised and matched against sentence
rules in order (the first that fits names the sentence), and the sequence of names of a
text is matched against licence rules in order: a rule takes its names where they
follow each other with nothing but filler between, takes them out, and the next rule looks at
the rest. Names that no rule takes are reported as unknown.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tidyspark.llm.common import small_batches, texts

#: Sentence rules: name, pattern over the normalised sentence. Earlier ones win.
SENTENCES = tuple(
    (name, re.compile(pattern))
    for name, pattern in (
        ("spdx", r"\bspdx license identifier (?P<id>[a-z0-9.+ -]+)$"),
        ("allrights", r"\ball rights reserved\b"),
        ("copyright", r"^(copyright|\(c\)) .*\d{4}"),
        ("ccnames", r"\b(cc|creative commons)\b.*\b(?P<id>by( (nc|sa|nd))*) ?(?P<v>\d \d)?\b"),
        ("apachever", r"\bapache (software )?license(,? version| v)? ?(?P<v>\d( \d)?)\b"),
        ("apachegrant", r"\byou may not use this file except in compliance with the license\b"),
        ("apacheasis", r"\bdistributed on an as is basis\b"),
        ("lgplver", r"\bgnu (lesser|library) general public license\b.*?(version |v)(?P<v>\d( \d)?)\b"),
        ("lgplname", r"\bgnu (lesser|library) general public license\b"),
        ("agplver", r"\bgnu affero general public license\b.*?(version |v)(?P<v>\d( \d)?)\b"),
        ("gplver", r"\bgnu (general )?public license\b.*?(version |v)(?P<v>\d( \d)?)\b"),
        ("gplname", r"\bgnu (general )?public license\b"),
        ("orlater", r"\bany later version\b"),
        ("mitname", r"\bmit license\b"),
        ("mitgrant", r"\bpermission is hereby granted free of charge to any person obtaining a copy\b"),
        ("mitnotice", r"\bshall be included in all copies or substantial portions\b"),
        ("asis", r"\bsoftware is provided as is\b"),
        ("bsdgrant", r"\bredistribution and use in source and binary forms\b"),
        ("bsdsource", r"\bredistributions of source code must retain\b"),
        ("bsdbinary", r"\bredistributions in binary form must reproduce\b"),
        ("bsdendorse", r"\bnor the names of (its|the) contributors\b|\bmay not be used to endorse\b"),
        ("bsdname", r"\b(?P<v>2|3|4) clause bsd license\b|\bbsd (?P<w>2|3|4) clause\b"),
        ("mplver", r"\bmozilla public license\b.*?(version |v ?)(?P<v>\d \d)\b"),
        ("publicdomain", r"\b(in|into) the public domain\b"),
        ("proprietary", r"\bproprietary and confidential\b"),
        ("mention", r"\blicen[sc]ed? (under|by)\b|\bunder the terms of\b.*\blicen[sc]e\b|\breleased under\b.*\blicen[sc]e\b"),
    )
)
#: Names that may stand between the parts of a rule.
FILLER = frozenset({"copyright", "allrights"})
#: Licence rules in order: sequence of sentence names, licence ({v}: the version, {id}: the named part).
RULES = (
    (("spdx",), "{id}"),
    (("apachever", "apachegrant", "apacheasis"), "Apache-{v}"),
    (("apachever", "apachegrant"), "Apache-{v}"),
    (("apachever",), "Apache-{v}"),
    (("mitname", "mitgrant", "mitnotice", "asis"), "MIT"),
    (("mitgrant", "mitnotice", "asis"), "MIT"),
    (("mitgrant", "mitnotice"), "MIT"),
    (("mitname",), "MIT"),
    (("bsdgrant", "bsdsource", "bsdbinary", "bsdendorse"), "BSD-3-Clause"),
    (("bsdgrant", "bsdsource", "bsdbinary"), "BSD-2-Clause"),
    (("bsdname",), "BSD-{v}-Clause"),
    (("lgplver", "orlater"), "LGPL-{v}-or-later"),
    (("lgplver",), "LGPL-{v}"),
    (("agplver", "orlater"), "AGPL-{v}-or-later"),
    (("agplver",), "AGPL-{v}"),
    (("gplver", "orlater"), "GPL-{v}-or-later"),
    (("gplver",), "GPL-{v}"),
    (("mplver",), "MPL-{v}"),
    (("ccnames",), "CC-{id}-{v}"),
    (("lgplname",), "LGPL"),
    (("gplname",), "GPL"),
    (("publicdomain",), "Public-Domain"),
    (("proprietary",), "Proprietary"),
)
_GAP = r"[^a-z0-9()+]+"  # what becomes one space, dots included
#: A text without any of these words holds no sentence that a rule knows: every rule needs one of them.
HINT = re.compile(
    r"licen[sc]|copyright|\(c\)|redistribution|confidential|contributors|endorse"
    r"|(?<![a-z0-9])(?:cc|bsd)(?![a-z0-9])"
    + "".join("|" + _GAP.join(words.split()) for words in (
        "creative commons", "public domain", "all rights", "permission is hereby", "substantial portions", "as is", "later version"
    )),
    re.I,
)
_SENTENCE = re.compile(r"(?:[^.!?\n]|[.!?](?=[^\s]))+[.!?]?")
#: Rules that name a whole line only.
ANCHORED = frozenset({"spdx", "copyright"})
#: Version rules that a sentence's "any later version" goes with.
VERSIONS = frozenset({"lgplver", "agplver", "gplver"})
_MARKUP = re.compile(r"[^a-z0-9.()+]+")
_WORD = re.compile(r"[a-zA-Z0-9]")
_NUMBER = re.compile(r"(?<=\d)\.(?=\d)")

Found = tuple[str, dict[str, str], int, int]


def normalised(sentence: str) -> str:
    """Lower case, one space between words, a dot between digits a space, other marks gone."""
    text = _NUMBER.sub(" ", sentence.lower().replace("licence", "license"))
    return " ".join(_MARKUP.sub(" ", text.replace(".", " ")).split())


def _named(plain: str) -> list[tuple[int, re.Match]]:
    """The first rule that fits, and an "any later version" behind a version."""
    for rank, (name, pattern) in enumerate(SENTENCES):
        if hit := pattern.search(plain):
            if name in VERSIONS and (later := _LATER[1].search(plain, hit.end())):
                return [(rank, hit), (_LATER[0], later)]
            return [(rank, hit)]
    return []


_LATER = next((rank, pattern) for rank, (name, pattern) in enumerate(SENTENCES) if name == "orlater")
_MENTION = next(rank for rank, (name, _) in enumerate(SENTENCES) if name == "mention")


def _wrapped(lines: list[tuple[str, int, int]]) -> list[Found]:
    """The names in the lines of one sentence: each line's own, and those of rules that reach over line breaks.

    A rule that reaches over a line break is not taken where a later line has a name of its own inside it, and
    takes the place of a weaker name of its first line.
    """
    own = [_named(plain) for plain, *_ in lines]  # (rule, match within the line)
    starts, total = [], 0
    for plain, *_ in lines:
        starts.append(total)
        total += len(plain) + 1
    hits = [(rank, starts[i] + h.start(), starts[i] + h.end(), i, i, h) for i, names in enumerate(own) for rank, h in names]
    if len(lines) > 1:
        whole = " ".join(plain for plain, *_ in lines)
        # Searched from one name to the next, so that a long text without full stops is gone through once.
        fixed = sorted((k for k in hits if k[0] != _MENTION), key=lambda k: k[1])
        edges = [0, *(k[1] for k in fixed), len(whole)]
        begins = [0, *(max(starts[k[3]], before) for k, before in zip(fixed, [0, *(k[2] for k in fixed)]))]
        by_line: dict[int, list] = {}
        for k in hits:
            by_line.setdefault(k[3], []).append(k)
        gone, added = set(), []
        for begin, end in zip(begins, edges[1:]):
            if bisect_right(starts, begin) == bisect_right(starts, end - 1) or not HINT.search(whole, begin, end):
                continue
            taken: list[tuple[int, int]] = []
            for rank, (name, pattern) in enumerate(SENTENCES):
                if name in ANCHORED:
                    continue
                for h in pattern.finditer(whole, begin, end):
                    a, b = (bisect_right(starts, at) - 1 for at in (h.start(), h.end() - 1))
                    if a == b or any(x < h.end() and h.start() < y for x, y in taken):
                        continue
                    inside = [k for i in range(a, b + 1) for k in by_line.get(i, ()) if k[1] < h.end() and h.start() < k[2]]
                    if any(k[3] > a and k[0] != _MENTION or k[0] <= rank for k in inside):
                        continue
                    taken.append(h.span())
                    # Weaker names of the first line go, as the first rule that fits names a sentence.
                    gone.update(inside, (k for k in by_line.get(a, ()) if k[0] > rank and k[2] <= h.start()))
                    added.append((rank, *h.span(), a, b, h))
        hits = [k for k in hits if k not in gone] + added
    hits.sort(key=lambda k: (k[1], k[2]))
    return [(SENTENCES[k[0]][0], {n: v for n, v in k[5].groupdict().items() if v}, lines[k[3]][1], lines[k[4]][2]) for k in hits]


def name_sentences(text: str) -> list[Found]:
    """(name, named parts, start, stop) of the sentences that a rule knows, in order.

    A line break alone does not end a sentence; a full stop and a line without words do.
    """
    if not HINT.search(text):
        return []
    found: list[Found] = []
    group: list[re.Match] = []

    def close() -> None:
        if group and HINT.search(text, group[0].start(), group[-1].end()):
            found.extend(_wrapped([(normalised(m[0]), *m.span()) for m in group]))
        group.clear()

    for match in _SENTENCE.finditer(text):
        if group and (match.start() - group[-1].end() != 1 or text[group[-1].end()] != "\n" or group[-1][0][-1] in ".!?"):
            close()
        if _WORD.search(match[0]):
            group.append(match)
        else:
            close()
    close()
    return found


def _label(template: str, parts: dict[str, str]) -> str:
    version = parts.get("v", parts.get("w", "")).replace(" ", ".")
    if version and "Clause" not in template and "." not in version:
        version += ".0"
    name = re.sub(r"(?<=\d)-(?=\d)", ".", parts.get("id", "").strip().replace(" ", "-").upper())
    return template.format(v=version, id=name).rstrip("-")


def match_licences(found: list[Found]) -> list[tuple[str, int, int]]:
    """(licence, start, stop) by the licence rules, then what they left as ``unknown``."""
    open_ = [f for f in found if f[0] not in FILLER]
    licences = []
    for names, template in RULES:
        at = 0
        while at + len(names) <= len(open_):
            run = open_[at : at + len(names)]
            if tuple(f[0] for f in run) == names:
                parts = {k: v for f in run for k, v in f[1].items()}
                licences.append((_label(template, parts), run[0][2], run[-1][3]))
                del open_[at : at + len(names)]
            else:
                at += 1
    licences += [("unknown", f[2], f[3]) for f in open_]
    return sorted(licences, key=lambda x: (x[1], x[2], x[0]))


LICENCES = "array<struct<licence: string, start: int, stop: int>>"


def scan_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, sentences, licences): names of the known sentences in order, and the licences with
    their spans (code points, stop exclusive) by start.

    Null and empty texts have neither. Rows are looked at one by one: repeated rows and null ids stay,
    an empty table gives no rows, other columns are ignored.
    """
    source = texts(docs, id_col, text_col)
    span = pa.list_(pa.struct([("licence", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", 1 << 22):
            named = [name_sentences(text) for text in batch.column("text").to_pylist()]
            licences = [[dict(zip(("licence", "start", "stop"), x)) for x in match_licences(f)] for f in named]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([[f[0] for f in x] for x in named], pa.list_(pa.string())), pa.array(licences, span)],
                ["doc_id", "sentences", "licences"],
            )

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, sentences array<string>, licences {LICENCES}")
