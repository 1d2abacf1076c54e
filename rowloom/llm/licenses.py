"""License scans: texts compared to licence templates by Dice coefficient over word bigrams.

A licence may stand anywhere in a text: in a sentence, over several paragraphs, between two pieces of code. So the units
compared to a template are all runs of words of a size that can reach the threshold, and the best of them is found
exactly. Three bounds spare most of the work without losing any: a unit at the threshold t shares at least t / (2 - t) of
a template's bigrams, so the text holds a word of every set of words that touches more than the rest; the text's own
count of shared bigrams must come to that; and a run's length lies within a factor of (2 - t) / t of the template's.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from importlib import resources

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.llm.batches import sliced, texts


def wordings() -> list[tuple[str, str]]:
    """(licence, text) of the full licence texts that come with the package, a file for each, named by its SPDX
    identifier (public wordings: fixed values)."""
    files = sorted((resources.files(__package__) / "wordings").iterdir(), key=lambda file: file.name)
    return [(file.name.removesuffix(".txt"), file.read_text(encoding="utf-8")) for file in files if file.name.endswith(".txt")]


_FULL = dict(wordings())
_MIT = _FULL["MIT"]

# Public wordings of file headers and notices: fixed values.
_APACHE_HEADER = (
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You '
    "may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
    'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
    "either express or implied. See the License for the specific language governing permissions and limitations under the License."
)
_GNU_HEADER = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the {0} as published by the Free Software "
    "Foundation, either version {1} of the License, or (at your option) any later version. This program is distributed in the hope that it "
    "will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. "
    "See the {0} for more details."
)
_MPL_HEADER = (
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
    "file, You can obtain one at https://mozilla.org/MPL/2.0/."
)

#: (licence, wording) of full texts, file headers and one-line notices.
TEMPLATES = [
    *_FULL.items(),
    ("Apache-2.0", _APACHE_HEADER),
    ("GPL-2.0", _GNU_HEADER.format("GNU General Public License", 2)),
    ("GPL-3.0", _GNU_HEADER.format("GNU General Public License", 3)),
    ("LGPL-2.1", _GNU_HEADER.format("GNU Lesser General Public License", 2.1)),
    ("LGPL-3.0", _GNU_HEADER.format("GNU Lesser General Public License", 3)),
    ("AGPL-3.0", _GNU_HEADER.format("GNU Affero General Public License", 3)),
    ("MPL-2.0", _MPL_HEADER),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("LGPL-2.1", "Licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at https://www.boost.org/LICENSE_1_0.txt)"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("EPL-2.0", "Eclipse Public License - v 2.0"),
    ("EPL-1.0", "Eclipse Public License - v 1.0"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
]

#: Variants of the Creative Commons notices, each in the versions given: short wording, long wording (fixed values).
_CC = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-ND": "Attribution-NoDerivatives", "BY-NC": "Attribution-NonCommercial", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
_CC_VERSIONS = ("2.0", "2.5", "3.0", "4.0")
TEMPLATES += [
    (f"CC-{kind}-{version}", wording)
    for kind, name in _CC.items() for version in _CC_VERSIONS
    for wording in (f"Licensed under CC {kind} {version}.", f"This work is licensed under a Creative Commons {name} {version} {'International' if version == '4.0' else 'Unported' if version == '3.0' else 'Generic'} License.")
]
#: Identifiers that a line of the form `SPDX-License-Identifier: ...` may name.
IDENTIFIERS = sorted({name for name, _ in TEMPLATES})
_TAG = re.compile(r"SPDX-License-Identifier:[ \t]*\(?[ \t]*([A-Za-z0-9][A-Za-z0-9.+-]*)", re.IGNORECASE)
#: Identifiers' endings that say how later versions count; without them they name the same text.
_ENDINGS = re.compile(r"(?:-only|-or-later|\+)$", re.IGNORECASE)

#: What tells short notices of one family apart: if a template's words name any of these, a run of its size that names
#: others, or none, is another licence's or an unknown one's.
_KINDS = {"sa": "sa", "sharealike": "sa", "nd": "nd", "noderivatives": "nd", "noderivs": "nd", "nc": "nc", "noncommercial": "nc", "lesser": "lesser", "library": "lesser", "affero": "affero"}
_VERSION = re.compile(r"v?([0-9]+(?:\.[0-9]+)*)")
#: Bigrams of a template up to which all its versions and kinds count; the words of longer ones stand for themselves.
SHORT = 120

_WORD = re.compile(r"[A-Za-z0-9]+(?:\.[0-9]+)*")


def marks(found: list[str]) -> tuple[frozenset, str | None]:
    """What a notice's words say of kind and version: the kinds named, and the first version, without an ending .0."""
    version = None
    for i, word in enumerate(found):
        named = _VERSION.fullmatch(word)
        if named and (i and found[i - 1] in ("version", "v", "license", "licence") or "." in word or word.startswith("v")):
            version = re.sub(r"(\.0)+$", "", named[1])
            break
    return frozenset(_KINDS[word] for word in found if word in _KINDS), version


def words(text: str) -> list[str]:
    """The normalised words: runs of ASCII letters and digits in lower case, dotted numbers whole."""
    return [word.lower() for word in _WORD.findall(text)]


def bigrams(text: str) -> frozenset[tuple[str, str]]:
    """Pairs of neighbouring words."""
    found = words(text)
    return frozenset(zip(found, found[1:]))


def dice(a: frozenset, b: frozenset) -> float:
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 0.0


@dataclass(frozen=True)
class Hit:
    license: str
    score: float
    start: int
    end: int

    def order(self) -> tuple:
        """Best first: the highest score, then the shortest run, then the first one, then by name."""
        return -self.score, self.end - self.start, self.start, self.license


class Scanner:
    def __init__(self, threshold: float, templates: list[tuple[str, str]]):
        self.threshold, self.factor = threshold, (2 - threshold) / threshold
        self.templates = [(name, pairs) for name, wording in templates if (pairs := bigrams(wording))]
        self.marks = [marks(words(wording)) if len(pairs) <= SHORT else None for _, wording in templates if (pairs := bigrams(wording))]
        self.of: dict[tuple[str, str], list[int]] = {}
        for number, (_, pairs) in enumerate(self.templates):
            for pair in pairs:
                self.of.setdefault(pair, []).append(number)
        self.names = {_ENDINGS.sub("", name).lower(): name for name, _ in self.templates}
        self.sizes = np.array([len(pairs) for _, pairs in self.templates], np.int64)
        self.cover = ahocorasick.Automaton()
        for _, pairs in self.templates:
            for word in self._cover(pairs):
                self.cover.add_word(word, word)
        if len(self.cover):
            self.cover.make_automaton()

    def _cover(self, pairs: frozenset) -> list[str]:
        """Words one of which any run at the threshold must hold: fewer bigrams avoid them all than such a run shares."""
        needed, avoiding, chosen = len(pairs) / self.factor, set(pairs), []
        for word in sorted({w for pair in pairs for w in pair}, key=lambda w: (-len(w), w)):
            if len(avoiding) < needed:
                break
            chosen.append(word)
            avoiding = {pair for pair in avoiding if word not in pair}
        return chosen

    def possible(self, text: str) -> bool:
        return len(self.cover) > 0 and next(self.cover.iter(text.lower()), None) is not None

    def tagged(self, text: str) -> list[Hit]:
        """The first line of each licence that names it by its identifier."""
        found: dict[str, Hit] = {}
        for m in _TAG.finditer(text):
            name = self.names.get(_ENDINGS.sub("", m[1]).lower())
            if name and name not in found:
                found[name] = Hit(name, 1.0, m.start(), m.end(1))
        return list(found.values())

    def best(self, text: str) -> dict[str, Hit]:
        """The best run of words for each licence that has one at the threshold."""
        if not self.possible(text):
            return {}
        spans = [m.span() for m in _WORD.finditer(text)]
        found = [text[a:b].lower() for a, b in spans]
        pairs = list(zip(found, found[1:]))
        shared: dict[int, int] = {}
        for pair in set(pairs):
            for number in self.of.get(pair, ()):
                shared[number] = shared.get(number, 0) + 1
        wanted = [number for number, n in shared.items() if n * self.factor >= self.sizes[number] - 1e-9]
        if not wanted:
            return {}
        last: dict[tuple[str, str], int] = {}
        previous = np.empty(len(pairs), np.int64)  # where each bigram was before
        for i, pair in enumerate(pairs):
            previous[i] = last.get(pair, -1)
            last[pair] = i
        best: dict[str, Hit] = {}
        for number in sorted(wanted):
            name, template = self.templates[number]
            run = self._best_run(np.fromiter(map(template.__contains__, pairs), bool, len(pairs)), previous, len(template))
            if run and self._agrees(number, found, run[1], run[2] + 1):
                hit = Hit(name, run[0], spans[run[1]][0], spans[run[2] + 1][1])
                best[name] = min(hit, best.get(name, hit), key=Hit.order)
        return best

    def _agrees(self, number: int, found: list[str], first: int, last: int) -> bool:
        """Whether the run's kind and version are those of its template. A version or kind may stand just outside the run, as
        a run ends where the template's words do; a template without a version takes any."""
        if self.marks[number] is None:
            return True
        kinds, version = self.marks[number]
        around = found[max(0, first - 1) : last + 4]
        own_kinds, own_version = marks(found[first : last + 1])
        near_kinds, near_version = marks(around)
        return kinds == own_kinds == near_kinds and (version is None or version == (own_version or near_version))

    def _best_run(self, shared: np.ndarray, previous: np.ndarray, size: int) -> tuple[float, int, int] | None:
        """(score, first bigram, last one) of the best run of bigrams, of (2 - t) / t times the template's size at most.
        It begins with a shared bigram, as a run without its first other one is no worse; runs from where too few follow
        to beat the best so far are left out."""
        most = int(size * self.factor + 1e-9)
        before = np.concatenate([[0], np.cumsum(shared)])
        starts = np.flatnonzero(shared)
        follow = np.minimum(before[np.minimum(starts + most, len(shared))] - before[starts], size)
        bound = 2 * follow / (follow + size)
        best, found = self.threshold - 1e-12, None
        for k in np.lexsort((starts, -bound)).tolist():
            i = int(starts[k])
            if bound[k] < best or (found and best >= 1 and found[2] - found[1] + 1 == size):
                break
            part = slice(i, i + most)
            new = previous[part] < i
            common = np.cumsum(new & shared[part])
            score = 2 * common / (np.cumsum(new) + size)
            j = int(score.argmax())
            if score[j] > best or (found and score[j] == best and (j, i) < (found[2] - found[1], found[1])):
                best, found = float(score[j]), (float(score[j]), i, i + j)
        return found

    def scan(self, text: str) -> list[Hit]:
        """The licences found, best first. Of hits that overlap only the best counts: a wording that is close to a
        template is so to its neighbours' too."""
        kept: list[Hit] = []
        for hit in sorted([*self.tagged(text), *self.best(text).values()], key=Hit.order):
            if all(hit.end <= other.start or other.end <= hit.start for other in kept):
                kept.append(hit)
        return kept


HITS = "array<struct<license: string, score: double, start: int, end: int>>"


def license_scan(docs: DataFrame, threshold: float = 0.8, templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """One row per input row: doc_id, license (the best match, null if none), score (its Dice coefficient, else 0),
    n_licenses, hits (the best run of each licence, best first; positions in code points).

    Of equal scores the shorter run comes first, then the earlier one, then the licence that sorts first. A null or empty
    text has no hit, nor has one of a single word. Null doc_ids and repeated rows are rows like others; an empty table
    gives an empty result. Columns other than doc_id and text are not looked at."""
    sent = docs.sparkSession.sparkContext.broadcast(TEMPLATES if templates is None else templates)  # some 250 KB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(threshold, sent.value)
        kind = pa.list_(pa.struct([("license", pa.string()), ("score", pa.float64()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in sliced(batches):
            found = [[vars(hit) for hit in scanner.scan(text)] for text in texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, kind)], ["doc_id", "hits"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, f"doc_id long, hits {HITS}")
    first = F.get("hits", F.lit(0))
    return rows.select("doc_id", first["license"].alias("license"), F.coalesce(first["score"], F.lit(0.0)).alias("score"), F.size("hits").alias("n_licenses"), "hits")
