"""License scans by patience alignment against templates.

A document's words are compared with each template's. Where a run of the document holds enough of a template's
word occurrences, parts of the run, cut so that one of them holds one copy, are aligned with the template: words that
occur once in both are anchors, the longest increasing subsequence of them is kept, and the gaps between anchors are
aligned in the same way. Coverage is the share of the template's words that were matched. Of each template all findings that don't
overlap are reported, those with the most matched words first chosen.
"""

from __future__ import annotations

import bisect
import functools
import heapq
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from .common import bounded, only, texts_of

#: Share of a template's words that a finding matches, and words without a template word that may part a run.
LEAST, GAP = 0.8, 8
WORD = re.compile(r"[a-z0-9]+")

# Notices and texts of public licenses.
TEMPLATES = {
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "mit-notice": "Released under the MIT License.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0-notice": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-2.0-notice": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License, version 2.",
    "bsd-notice": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "mpl-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "all-rights-reserved": "Copyright. All rights reserved.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "gpl-2.0-or-later": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "gpl-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/.",
    "lgpl-2.1-or-later": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.",
    "agpl-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details.",
    "mpl-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: The origin of this software must not be misrepresented; you must not claim that you wrote the original software.",
    "bsl-1.0": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so.",
    "cc0-1.0-notice": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "software-disclaimer": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "bsd-3-clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "bsd-2-clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
}


Template = tuple[str, list[str], Counter[str]]


def prepared(texts: dict[str, str]) -> list[Template]:
    """(name, words, how often each word occurs) of each template with a word."""
    split = {name: WORD.findall(text.lower()) for name, text in texts.items()}
    return [(name, words, Counter(words)) for name, words in split.items() if words]


@functools.lru_cache(maxsize=1)
def templates() -> list[Template]:
    return prepared(TEMPLATES)


def increasing(values: list[int]) -> list[int]:
    """Places of a longest increasing subsequence (patience sorting)."""
    tops: list[int] = []
    piles: list[int] = []
    back = [-1] * len(values)
    for i, v in enumerate(values):
        p = bisect.bisect_left(tops, v)
        back[i] = piles[p - 1] if p else -1
        if p == len(tops):
            tops.append(v)
            piles.append(i)
        else:
            tops[p], piles[p] = v, i
    out, at = [], piles[-1] if piles else -1
    while at >= 0:
        out.append(at)
        at = back[at]
    return out[::-1]


def patience(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Matched places (in a, in b), in order. Equal words at both ends of a gap are matched first, then unique anchors."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        once = {w: i for i, w in enumerate(b[b0:b1], b0) if in_b[w] == 1 and in_a.get(w) == 1}
        places = [(i, once[w]) for i, w in enumerate(a[a0:a1], a0) if w in once]
        anchors = [places[k] for k in increasing([j for _, j in places])]
        if not anchors:
            continue
        out += anchors
        edges = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
        todo += [(p + 1, r, q + 1, s) for (p, q), (r, s) in zip(edges, edges[1:])]
    return sorted(out)


def gap_of(want: list[str], least: float) -> int:
    """Words without a template word that may part a run: GAP, or as many as a finding may miss in one stretch."""
    return max(GAP, int((1 - least) * len(want) + 1e-9))


def held(words: list[str], counts: Counter[str]) -> int:
    """At most so many template words can be matched in these words: each as often as it occurs in both."""
    return (Counter(w for w in words if w in counts) & counts).total()


def runs(words: list[str], vocabulary: Counter[str], gap: int = GAP) -> list[tuple[int, int]]:
    """Runs (from, to) of the words in which template words are at most `gap` apart."""
    out: list[list[int]] = []
    for i, w in enumerate(words):
        if w in vocabulary:
            if out and i - out[-1][1] <= gap:
                out[-1][1] = i + 1
            else:
                out.append([i, i + 1])
    return [(a, b) for a, b in out]


#: Words of a template beyond which parts are found by common subsequences instead of by each bound, and the steps from the least to the longest one.
LONG, STEPS = 320, 2


def masks_of(want: list[str]) -> dict[str, int]:
    """The places of each of the template's words as bits."""
    places: dict[str, list[int]] = {}
    for i, w in enumerate(want):
        places.setdefault(w, []).append(i)
    return {w: sum(1 << i for i in at) for w, at in places.items()}


def longest_common(words: list[str], masks: dict[str, int], size: int) -> int:
    """Length of the longest common subsequence with the template of `size` words, a row of bits a word: no alignment matches more."""
    whole = (1 << size) - 1
    row = whole
    for w in words:
        if (m := masks.get(w)) is not None:
            up = row & m
            row = ((row + up) | (row - up)) & whole
    return size - row.bit_count()


def reached(words: list[str], masks: dict[str, int], size: int, levels: list[int]) -> list[int]:
    """How many words it takes until a common subsequence is as long as each of the rising levels, as far as they are reached."""
    whole = (1 << size) - 1
    row, out, k = whole, [], 0
    for i, w in enumerate(words, 1):
        if (m := masks.get(w)) is not None:
            up = row & m
            row = ((row + up) | (row - up)) & whole
            have = size - row.bit_count()
            while k < len(levels) and have >= levels[k]:
                out.append(i)
                k += 1
            if k == len(levels):
                break
    return out


def windows(words: list[str], a: int, b: int, counts: Counter[str], need: int, size: int) -> list[tuple[int, int, int]]:
    """(bound, from, to) of parts of a run that may hold a finding, highest bound first.

    For each bound from `need` to the whole template: every part of at most `size` words that holds so many of the template's
    word occurrences and no shorter part inside it does, so a part ends where one copy does. Besides, the run itself if it
    is no longer than `size`, else parts of `size` words, half overlapping.
    """
    step = size // 2
    wide = [(a, b)] if b - a <= size else [(p, min(b, p + size)) for p in range(a, b - step, step)]
    out = [(k, p, q) for p, q in wide if (k := held(words[p:q], counts)) >= need]
    hits = [(i, words[i]) for i in range(a, b) if words[i] in counts]
    for level in range(need, counts.total() + 1):
        seen: Counter[str] = Counter()
        have = left = 0
        last = -1
        for i, w in hits:
            seen[w] += 1
            have += seen[w] <= counts[w]
            while True:
                p, first = hits[left]
                spare = seen[first] > counts[first]
                if not (spare or have > level or i + 1 - p > size):
                    break
                seen[first] -= 1
                have -= not spare
                left += 1
            if have == level and left != last:
                out.append((level, p, i + 1))
                last = left
        if last < 0:
            break
    return sorted(out, key=lambda x: (-x[0], x[2] - x[1], x[1]))


Finding = tuple[str, float, int, int, int]


def free(taken: list[tuple[int, int]], p: int, q: int) -> list[tuple[int, int]]:
    """What the sorted findings leave of a part."""
    left = []
    for a, b in taken[max(0, bisect.bisect_left(taken, (p, p)) - 1) :]:
        if a >= q:
            break
        if b > p:
            left.append((p, a))
            p = b
    return [(a, b) for a, b in [*left, (p, q)] if a < b]


def extended(words: list[str], want: list[str], p: int, q: int, align) -> tuple[int, int, int] | None:
    """(matched words, first, behind the last) of a part, or of it and what the template still has before and behind its matched words, if that matches more."""
    match = align(p, q)
    tried = [(p, match)]
    if match:
        (i, j), (k, m) = match[0], match[-1]
        start = max(0, p + i - j)
        tried.append((start, align(start, min(len(words), p + k + len(want) - m))))
    at, match = max(tried, key=lambda x: len(x[1]))
    return (len(match), at + match[0][0], at + match[-1][0] + 1) if match else None


def long_findings(words: list[str], template: Template, least: float) -> list[Finding]:
    """findings_of() for a long template, in time about the words' number times the template's.

    Every finding lies in one of the stretches of `size` words and a step that begin a step after each other, and matches no more than the stretch's longest
    common subsequence with the template. Stretches wait by that bound; those without the words needed are left out. The best one's parts, for some
    lengths from that needed to the longest the shortest end at which it is reached and the latest start from which that end reaches it, are
    aligned and extended, and the stretch waits again with the best of them. When one is taken, what it leaves of the stretches that it meets is looked at anew.
    """
    name, want, counts = template
    n = len(want)
    need, size, step = math.ceil(least * n - 1e-9), 2 * n + GAP, max(GAP, n // 8)
    masks, back = masks_of(want), masks_of(want[::-1])
    known: dict[tuple[int, int], tuple[int, int, int] | None] = {}
    taken: list[tuple[int, int]] = []
    out: list[Finding] = []
    # (bound or matched, aligned ones first of equals, length, first, behind the last, stretch)
    waiting: list[tuple[int, int, int, int, int, int, int]] = []

    def look(p: int, q: int) -> None:
        if q - p >= need and (most := longest_common(words[p:q], masks, n)) >= need:
            heapq.heappush(waiting, (-most, 1, q - p, p, q, p, q))

    def best_part(p: int, q: int, most: int) -> tuple[int, int, int] | None:
        found = []
        levels = sorted({need + (most - need) * k // STEPS for k in range(STEPS + 1)})
        for level, end in zip(levels, reached(words[p:q], masks, n, levels)):
            part = (p + end - reached(words[p : p + end][::-1], back, n, [level])[0], p + end)
            if part not in known:
                known[part] = extended(words, want, *part, lambda a, b: patience(words[a:b], want))
            found.append(known[part])
        return max((f for f in found if f and f[0] >= need), key=lambda f: (f[0], f[1] - f[2]), default=None)

    for a, b in runs(words, counts, gap_of(want, least)):
        for p in range(a, max(a + 1, b - size), step):
            look(p, min(b, p + size + step))
    while waiting:
        bound, raw, _, a, b, p, q = heapq.heappop(waiting)
        if raw and free(taken, p, q) == [(p, q)]:
            if found := best_part(p, q, -bound):
                heapq.heappush(waiting, (-found[0], 0, found[2] - found[1], found[1], found[2], p, q))
            continue
        if not raw and free(taken, a, b) == [(a, b)]:
            bisect.insort(taken, (a, b))
            out.append((name, -bound / n, a, b, -bound))
        for x, y in free(taken, p, q):
            look(x, y)
    return out


def findings_of(words: list[str], template: Template, least: float) -> list[Finding]:
    """The template's findings that don't overlap, most matched words first: its name, coverage, first word, word behind the last, matched words.

    Parts of runs wait in the order of their bounds; the best is aligned and waits again with what it matched, and is a finding
    once nothing before it can match more. A part that meets a finding goes on as what is left of it. Stretches of a run whose longest common
    subsequence with the template falls short hold no finding, whatever words they share, and their parts aren't aligned.
    """
    name, want, counts = template
    if len(want) > LONG:
        return long_findings(words, template, least)
    need, size = math.ceil(least * len(want) - 1e-9), 2 * len(want) + GAP
    known: dict[tuple[str, ...], list[tuple[int, int]]] = {}  # of short parts, which repeat
    taken: list[tuple[int, int]] = []
    out: list[Finding] = []

    def aligned(p: int, q: int) -> list[tuple[int, int]]:
        key = tuple(words[p:q])
        if key in known:
            return known[key]
        match = patience(key, want)
        if len(key) <= 64 * GAP:
            known[key] = match
        return match

    masks, stretch = masks_of(want), max(GAP, len(want) // 4)
    hopeless: list[tuple[int, int]] = []

    def possible(p: int, q: int) -> bool:
        return longest_common(words[p:q], masks, len(want)) >= need

    # (matched or bound, aligned ones first of equals, length, from, to)
    waiting = []
    for a, b in runs(words, counts, gap_of(want, least)):
        open_ = [(p, min(b, p + 2 * size)) for p in range(a, max(a + 1, b - size), size)]  # every part lies within one of these
        open_ = [(p, q) for p, q in open_ if possible(p, q)]
        if open_:
            waiting += [(-bound, 1, q - p, p, q) for bound, p, q in windows(words, a, b, counts, need, size) if any(x <= p and q <= y for x, y in open_[max(0, bisect.bisect_right(open_, (p, b)) - 2) : bisect.bisect_right(open_, (p, b))])]
    heapq.heapify(waiting)
    while waiting:
        bound, raw, _, p, q = heapq.heappop(waiting)
        left = free(taken, p, q)
        if left != [(p, q)]:
            for a, b in left:
                if b - a >= need and (most := held(words[a:b], counts)) >= need:
                    heapq.heappush(waiting, (-most, 1, b - a, a, b))
        elif not raw:
            bisect.insort(taken, (p, q))
            out.append((name, -bound / len(want), p, q, -bound))
        elif not any(x <= p and q <= y for x, y in hopeless):
            match = aligned(p, q)
            found = extended(words, want, p, q, aligned) if match and len(match) < -bound else (len(match), p + match[0][0], p + match[-1][0] + 1) if match else None
            if found and found[0] >= need:
                heapq.heappush(waiting, (-found[0], 0, found[2] - found[1], *found[1:]))
            elif not possible(x := max(0, p - stretch), y := min(len(words), q + stretch)):
                hopeless.append((x, y))
    return out


def texts_in(spark: SparkSession, folder: str) -> dict[str, str]:
    """Templates by name from a folder of license files, one file each, for scan(texts=...): the bodies of whole licenses, say."""
    return {r.path.rsplit("/", 1)[-1]: r.content.decode("utf-8", "replace") for r in spark.read.format("binaryFile").load(folder).select("path", "content").collect()}


def scan_words(words: list[str], least: float = LEAST, known: list[Template] | None = None) -> list[tuple[str, float, int, int]]:
    """(template, coverage, first word, word behind the last) of every template's findings, best first."""
    found: list[Finding] = []
    for template in templates() if known is None else known:
        if held(words, template[2]) >= math.ceil(least * len(template[1]) - 1e-9):
            found += findings_of(words, template, least)
    return [f[:4] for f in sorted(found, key=lambda f: (-f[1], -f[4], f[0], f[2]))]


def scan(docs: DataFrame, least: float = LEAST, texts: dict[str, str] | None = None) -> DataFrame:
    """doc_id, license (the best finding's template; null if none), coverage, n_licenses (templates found), n_findings, findings (template:per mille:first word:end word, comma-joined) of every row.

    `texts` are templates by name in place of TEMPLATES. Null text counts as empty: no finding. Ties go to the longer match, then to the
    template's name, then to the earlier place; repeated rows repeat, a null id stays null, an empty table gives no rows, other columns
    aren't read.
    """
    known = prepared(TEMPLATES if texts is None else texts)

    def run(batches):
        vocabulary = pa.array(sorted(set().union(*(v for _, _, v in known))), pa.string())
        index = {w: i for i, w in enumerate(vocabulary.to_pylist())}
        times = np.zeros((len(vocabulary), len(known)), np.int64)
        for t, (_, _, counts) in enumerate(known):
            times[[index[w] for w in counts], t] = list(counts.values())
        need = np.array([least * len(want) - 1e-9 for _, want, _ in known])
        for batch in bounded(batches):
            texts = pc.ascii_lower(texts_of(batch))
            parts = pc.split_pattern(pc.replace_substring_regex(texts, "[^a-z0-9]+", " "), " ")
            doc = np.repeat(np.arange(len(texts)), np.diff(parts.offsets.to_numpy()))
            coded = parts.flatten().dictionary_encode()
            place = pc.index_in(coded.dictionary, value_set=vocabulary).fill_null(-1).to_numpy(zero_copy_only=False)[coded.indices.to_numpy()]
            hit = place >= 0
            pair, n = np.unique(doc[hit].astype(np.int64) * len(vocabulary) + place[hit], return_counts=True)
            have = np.zeros((len(texts), len(known)), np.int64)
            of, word = pair // max(1, len(vocabulary)), pair % max(1, len(vocabulary))
            first = np.flatnonzero(np.diff(of, prepend=-1))  # a text's pairs stand together
            for t in range(len(known) if len(first) else 0):
                have[of[first], t] = np.add.reduceat(np.minimum(times[word, t], n), first)
            rows = [(None, 0.0, 0, 0, "")] * len(texts)
            for i in np.flatnonzero((have >= need).any(axis=1)):
                own = [k for k, ok in zip(known, have[i] >= need) if ok]
                if found := scan_words(WORD.findall(texts[int(i)].as_py()), least, own):
                    rows[i] = (found[0][0], found[0][1], len({f[0] for f in found}), len(found), ",".join(f"{n}:{round(1000 * c)}:{a}:{b}" for n, c, a, b in found))
            columns = list(zip(*rows)) if rows else [[]] * 5
            types = [pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types))], names=["doc_id", "license", "coverage", "n_licenses", "n_findings", "findings"])

    return only(docs, "doc_id", "text").mapInArrow(run, "doc_id long, license string, coverage double, n_licenses long, n_findings long, findings string")
