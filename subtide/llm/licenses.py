"""License scans by canonical digests.

A text is normalised: small letters, copyright lines dropped, equivalent spellings made one, all
but letters and digits dropped. Texts whose normal forms have the SHA-256 of a known licence's are
that licence. The hash join is on the digest of the entire text and, for notices, on the digest of
each whole line; no part of a line matches. Long licences are known by their digests alone, as a licence table
of one's own may be (`license_scan` takes any number of them).

Null and empty texts, and those of copyright lines only, have a null digest and no licence; very long ones are
digested whole. Repeated rows are reported one by one, an empty table gives an empty one, and columns other than
doc_id and text take no part, whatever their names. A document's lines meet again where they came from, so that one row
per document is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Short licences and notices, as published, by SPDX identifier.
KNOWN = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
    (
        "MIT",
        "MIT License\n\nCopyright (c) <year> <copyright holders>\n\n"
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including '
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions:\n\n"
        "The above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software.\n\n"
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
        "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER "
        "IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE "
        "USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "ISC License\n\nCopyright (c) <year> <owner>\n\n"
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n"
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE '
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
        "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF "
        "USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF "
        "OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "BSD-2-Clause",
        "BSD 2-Clause License\n\nCopyright (c) <year>, <owner>\n\n"
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:\n\n"
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer.\n\n"
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution.\n\n"
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
        "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
        "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
        "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
        "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH "
        "DAMAGE.",
    ),
    (
        "BSD-3-Clause",
        "BSD 3-Clause License\n\nCopyright (c) <year>, <owner>\n\n"
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:\n\n"
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer.\n\n"
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution.\n\n"
        "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.\n\n"
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
        "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
        "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
        "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
        "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH "
        "DAMAGE.",
    ),
    (
        "0BSD",
        "BSD Zero Clause License\n\nCopyright (c) <year> <owner>\n\n"
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted.\n\n"
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE '
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
        "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF "
        "USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF "
        "OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "Zlib",
        "zlib License\n\nCopyright (c) <year> <owner>\n\n"
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
        "held liable for any damages arising from the use of this software.\n\n"
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and "
        "to alter it and redistribute it freely, subject to the following restrictions:\n\n"
        "1. The origin of this software must not be misrepresented; you must not claim that you wrote the original "
        "software. If you use this software in a product, an acknowledgment in the product documentation would be "
        "appreciated but is not required.\n\n"
        "2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the "
        "original software.\n\n"
        "3. This notice may not be removed or altered from any source distribution.",
    ),
    (
        "BSL-1.0",
        "Boost Software License - Version 1.0 - August 17th, 2003\n\n"
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software "
        'and accompanying documentation covered by this license (the "Software") to use, reproduce, display, '
        "distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit "
        "third-parties to whom the Software is furnished to do so, all subject to the following:\n\n"
        "The copyright notices in the Software and this entire statement, including the above license grant, this "
        "restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, "
        "and all derivative works of the Software, unless such copies or derivative works are solely in the form of "
        "machine-executable object code generated by a source language processor.\n\n"
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED '
        "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT "
        "SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, "
        "WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR "
        "OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain.\n\n"
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code "
        "form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.\n\n"
        "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all "
        "copyright interest in the software to the public domain. We make this dedication for the benefit of the public "
        "at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of "
        "relinquishment in perpetuity of all present and future rights to this software under copyright law.\n\n"
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED '
        "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL "
        "THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE "
        "SOFTWARE.\n\n"
        "For more information, please refer to <https://unlicense.org>",
    ),
)

# Spellings that count as the same word.
SPELLINGS = (
    ("licence", "license"),
    ("licenced", "licensed"),
    ("sublicence", "sublicense"),
    ("organisation", "organization"),
    ("favour", "favor"),
    ("merchantibility", "merchantability"),
    ("noncommercial", "non commercial"),
    ("copyright owner", "copyright holder"),
    ("https", "http"),
    ("v", "version"),
)

# Digests of the normal forms of long licences, whole and, for three, without what follows their terms.
DIGESTS = (
    ("Apache-2.0", "6074c3536c43b739207170b87d1681477d0f07374ed3d862ba461334cce848e3"),
    ("Apache-2.0", "f70a2718f78121f2da77cd6afbffffbd668d7c1fd36c85a3ef121e83cb5f48fe"),
    ("Artistic-1.0-Perl", "e963bc30f4d3c45f45030c34409ee37315564625649c1394e32bb5ddd99e01b2"),
    ("CC0-1.0", "0c3e4ca5ed7ced6289d3f5d9a83e4100f9f34d87983b17dc5865376a8a0a98f3"),
    ("GFDL-1.2", "94541e73869af10ab6bd68a29575eede324e54e7d5237e7386d12444f593af60"),
    ("GFDL-1.3", "a92fdbaeafedd9cbeb812ebbded06ee07e3b1427c81cfc333e682109c594d826"),
    ("GPL-1.0", "ec8a6b7d70e9f225b63d3962ed5b4721373f5535d7b967a06722b0d621f6892a"),
    ("GPL-2.0", "331b500eb3c5ee796906547305df82fff4a35b3aa03c1d3ea84d32078292b2e6"),
    ("GPL-2.0", "1551b61aa183f987ecceedd8966ec1e9b2da3848f8862c2adedc0d82f41904ca"),
    ("GPL-3.0", "eaab5d82fdcca441d83a1913bbf07e4de3a739e190578c0bffde24f84e93bb2a"),
    ("GPL-3.0", "ac6b52d57c0104e687039148f7b8e370e04c9bb5705bb786f8ef814eb65e8636"),
    ("LGPL-2.0", "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908"),
    ("LGPL-2.1", "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "cbbde7eeab9b4d180dc00b34252f800e97fb1cddbab38ed8c0c73b956dc2cbf6"),
    ("MPL-2.0", "9672a697b80e59f5b1b0201e64d65dee8762b193cdd934dc5bcf2b57350a2ead"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
COPYRIGHT_LINE = "(^|\\n)[^a-z0-9\\n]*(copyright +(\\(c\\)|©|[0-9<])|\\(c\\) *[0-9<]|© *[0-9<]|all rights reserved)[^\\n]*"


def canonical(text: Column) -> Column:
    """Letters and digits of the text, words one blank apart, without copyright lines."""
    text = F.translate(text, _UPPER, _LOWER)
    text = F.regexp_replace(text, COPYRIGHT_LINE, "$1")
    text = F.concat(F.lit(" "), F.trim(F.regexp_replace(text, "[^a-z0-9\\x{80}-\\x{10FFFF}]+", " ")), F.lit(" "))
    for other, plain in SPELLINGS:
        text = F.replace(text, F.lit(f" {other} "), F.lit(f" {plain} "))
    return F.nullif(F.trim(text), F.lit(""))


def known_licenses(spark) -> DataFrame:
    """(license, digest) of the built-in texts and of DIGESTS."""
    long = spark.createDataFrame(DIGESTS, "license string, digest string")
    return digests(spark.createDataFrame(KNOWN, "license string, text string")).unionByName(long)


def digests(licenses: DataFrame) -> DataFrame:
    """(license, digest) of a table (license, text); a digest has its first license by name."""
    return licenses.select("license", F.sha2(canonical(F.col("text")), 256).alias("digest")).where("digest IS NOT NULL").groupBy("digest").agg(F.min("license").alias("license"))


def license_scan(docs: DataFrame, licenses: DataFrame) -> DataFrame:
    """Per row of `docs` (doc_id, text): the digest of the entire text, the licence that it is, and
    those that whole lines of it are, sorted. `licenses` has (digest, license)."""
    text = F.col("text").cast("string")
    rows = docs.select("doc_id", text.alias("text"), F.monotonically_increasing_id().alias("row"), F.sha2(canonical(text), 256).alias("text_digest"))
    # The text itself doesn't ride along with each of its lines.
    lines = rows.select("row", "doc_id", "text_digest", F.posexplode_outer(F.split("text", "\n")).alias("at", "line"))
    told = lines.select("row", "doc_id", "at", "text_digest", F.sha2(canonical(F.col("line")), 256).alias("digest"))
    # The planner broadcasts the licences if it knows them to be small.
    matched = told.join(licenses.withColumnRenamed("license", "notice"), "digest", "left").where("notice IS NOT NULL OR coalesce(at, 0) = 0")
    by_row = matched.groupBy("row", "doc_id").agg(
        F.max("text_digest").alias("text_digest"), F.array_join(F.sort_array(F.collect_set("notice")), ",").alias("notices")
    )
    return by_row.join(licenses.withColumnRenamed("digest", "text_digest"), "text_digest", "left").select("doc_id", "text_digest", "license", "notices")


def _canonical_sql(text: str) -> str:
    text = f"regexp_replace(translate({text}, '{_UPPER}', '{_LOWER}'), '{COPYRIGHT_LINE}', '\\1', 'g')"
    text = f"' ' || trim(regexp_replace({text}, '[^a-z0-9\\x{{80}}-\\x{{10FFFF}}]+', ' ', 'g')) || ' '"
    for other, plain in SPELLINGS:
        text = f"replace({text}, ' {other} ', ' {plain} ')"
    return f"nullif(trim({text}), '')"


def scan_sql() -> str:
    """The same scan of `documents` by the built-in licences, in DuckDB's SQL."""
    values = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in KNOWN)
    long = ", ".join(f"('{name}', '{digest}')" for name, digest in DIGESTS)
    return f"""
    WITH known AS (
      SELECT sha256({_canonical_sql('text')}) AS digest, min(name) AS license FROM (VALUES {values}) k(name, text) GROUP BY 1
      UNION ALL SELECT digest, name FROM (VALUES {long}) d(name, digest)
    ), docs AS (
      SELECT doc_id, text, row_number() OVER () AS r, sha256({_canonical_sql('text')}) AS text_digest FROM documents
    ), lines AS (
      SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs
    ), notices AS (
      SELECT r, string_agg(DISTINCT license, ',' ORDER BY license) AS notices
      FROM lines JOIN known ON sha256({_canonical_sql('line')}) = digest GROUP BY r
    )
    SELECT doc_id, text_digest, license, coalesce(notices, '') AS notices
    FROM docs LEFT JOIN known ON text_digest = digest LEFT JOIN notices USING (r)
    """
