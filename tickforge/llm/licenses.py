"""Operator 1: licence scan by canonical digest lookup (DataFrame functions only).

A text is brought to a canonical form -- A-Z lower-cased, copyright lines dropped, equivalent
spellings unified, punctuation and white space collapsed to single spaces, a title line such as "MIT
License" dropped -- and the SHA-256 of that form is hash-joined with the digests of known licence
texts.  Short licences are listed as texts, long ones by their digest alone.  The
catalogue is a parameter of fixed size, so its side of the join may be broadcast; ``catalogue``
also takes further digests, e.g. from a table of a user's own.

Two units are looked up: the entire text (``license_id``), and every entire line as a licence
notice (``notice_ids``), row by row and without a shuffle.  Only lines that hold ``licen`` (as every
notice does, in either spelling) are brought to the canonical form.

Nulls: a NULL text is empty; an empty canonical form matches nothing.  Every input row gives
one output row, whatever its id.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Equivalent spellings (pattern, replacement), applied in this order.
SPELLINGS = [
    ("licence", "license"),
    ("sub-license", "sublicense"),
    ("non-commercial", "noncommercial"),
    ("non-infringement", "noninfringement"),
    ("copyright-holder", "copyright holder"),
    ("merchantibility", "merchantability"),
    ("acknowledgement", "acknowledgment"),
    ("organisation", "organization"),
    ("authorisation", "authorization"),
    ("copyright owner", "copyright holder"),
    ("https://", "http://"),
]

# Licence texts by SPDX name.
TEXTS = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of
the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS
OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee
is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN
AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.""",
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee
is hereby granted.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN
AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
following disclaimer in the documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the
authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to
alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software.
If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is
not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original
software.
3. This notice may not be removed or altered from any source distribution.""",
}

TEXTS["BSD-3-Clause"] = TEXTS["BSD-2-Clause"].replace("provided with the distribution.\n", """provided with the distribution.
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission.
""")

# SHA-256 of the canonical form of the standard long texts (Apache-2.0 with and without its appendix).
DIGESTS = [
    ("Apache-2.0", "04e64e0427d80fdde16fa8415931bf2c09bc943f13ec322a09df188bf23a3543"),
    ("Artistic-1.0-Perl", "e963bc30f4d3c45f45030c34409ee37315564625649c1394e32bb5ddd99e01b2"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("GFDL-1.3", "2d36daeff2ad303badb6dee8149748be25e22974dd468e1e8a55cf40f16fc01d"),
    ("GPL-1.0", "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224"),
    ("GPL-2.0", "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821"),
    ("GPL-3.0", "eaab5d82fdcca441d83a1913bbf07e4de3a739e190578c0bffde24f84e93bb2a"),
    ("LGPL-2.0", "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908"),
    ("LGPL-2.1", "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "cbbde7eeab9b4d180dc00b34252f800e97fb1cddbab38ed8c0c73b956dc2cbf6"),
    ("MPL-2.0", "6fedd8db6adb0e102fc0f69b9e1501d2edaf25940e34910831cab46f9f5d4e4d"),
    ("Apache-2.0", "119e2da0e9ec849d113a40405b338c1bbbd2ef9194c22bf2740fa4e195411c40"),
    ("Apache-2.0", "824065d72ca31b7c727341396be4cf76f464b15d9bef680a3638007ce92a009f"),
]

# Notices that stand as a line of their own.
NOTICES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-or-later"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("LGPL-2.1", "SPDX-License-Identifier: LGPL-2.1-or-later"),
    ("LGPL-3.0", "SPDX-License-Identifier: LGPL-3.0-or-later"),
    ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"),
]

# A line that opens with "copyright" and names a year or the sign, or with the sign and a year.
COPYRIGHT_LINE = (r"(^|\n)[^a-z0-9\n]*(copyright[^\n]*(\(c\)|©|<year>|\[year\]|\[yyyy\]|[0-9]{4})|\(c\)[^\n]*[0-9]{4}|"
                  r"©[^\n]*[0-9]{4})[^\n]*")
PUNCTUATION = r"[\x00-\x2F\x3A-\x60\x7B-\x7F‘’“”–—©]+"
# Titles that stand above a licence's text, in canonical form.
TITLE = (r"^(the )?(mit|expat|isc|zlib|0bsd|bsd zero clause|bsd 2 clause|simplified bsd|freebsd|bsd 3 clause|new bsd|modified bsd|"
         r"bsd) license( mit| expat| isc| 0bsd)? ")


def canonical(text: Column) -> Column:
    """The canonical form a digest is taken of."""
    t = F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER)
    t = F.regexp_replace(t, COPYRIGHT_LINE, "$1")
    t = F.regexp_replace(t, r"(^|\n)[^a-z0-9\n]*all rights reserved[^a-z0-9\n]*(\n|$)", "$1")
    for old, new in SPELLINGS:
        t = F.replace(t, F.lit(old), F.lit(new))
    return F.regexp_replace(F.trim(F.regexp_replace(t, PUNCTUATION, " ")), TITLE, "")


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known_texts(texts: dict[str, str] | None = None) -> list[tuple[str, str]]:
    """(license, text) pairs; a text with a numbered list also without the numbers, as many files have it."""
    pairs = list((texts or TEXTS).items())
    return pairs + [(k, plain) for k, t in pairs if (plain := re.sub(r"(?m)^[1-9]\. ", "", t)) != t]


def catalogue(spark: SparkSession, texts: dict[str, str] | None = None, digests: list[tuple[str, str]] | None = None) -> DataFrame:
    """``license_id`` and ``digest`` of known texts; a handful of rows made from literals."""
    rows = [F.struct(F.lit(k).alias("license_id"), digest(F.lit(v)).alias("digest")) for k, v in known_texts(texts)]
    long = DIGESTS if digests is None and texts is None else digests or []
    rows += [F.struct(F.lit(k).alias("license_id"), F.lit(v).alias("digest")) for k, v in long]
    return (spark.range(1).select(F.inline(F.array(*rows)))
            .groupBy("digest").agg(F.min("license_id").alias("license_id")))


def scan_licenses(docs: DataFrame, texts: dict[str, str] | None = None, notices=None, id_col: str = "doc_id",
                  text_col: str = "text", digests: list[tuple[str, str]] | None = None) -> DataFrame:
    """id, ``text_sha256`` (of the canonical form), ``license_id`` (or NULL), ``n_notices`` and
    ``notice_ids`` (sorted, comma-joined; empty if none)."""
    known = catalogue(docs.sparkSession, texts, digests).select(F.col("digest").alias("text_sha256"), "license_id")
    lines = F.split(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "\n", -1)
    pairs = notices if notices is not None else NOTICES
    if all("licen" in t.lower() for _, t in pairs):
        lines = F.filter(lines, lambda x: x.rlike("(?i)licen"))
    known_lines = F.array(*[F.struct(digest(F.lit(t)).alias("d"), F.lit(i).alias("i")) for i, t in pairs])

    def named(mine: Column) -> Column:
        """The licence a line's digest names, as an array of none or one."""
        return F.slice(F.transform(F.filter(known_lines, lambda k: k["d"] == mine), lambda k: k["i"]), 1, 1)

    # Digests first: an expression inside the filter would be computed again for every notice.
    found = F.flatten(F.transform(F.transform(lines, digest), named))
    rows = docs.select(F.col(id_col), digest(F.col(text_col)).alias("text_sha256"), found.alias("found"))
    return (rows.join(F.broadcast(known), "text_sha256", "left")
            .select(id_col, "text_sha256", "license_id", F.size("found").cast("long").alias("n_notices"),
                    F.array_join(F.array_sort(F.array_distinct("found")), ",").alias("notice_ids")))

