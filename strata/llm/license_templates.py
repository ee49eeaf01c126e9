"""License texts and notices in template markup.

``<<beginOptional>> ... <<endOptional>>`` may be absent; ``<<var N>>`` stands
for zero to N words of any kind; everything else is mandatory wording. Spelling
variants that count as equal are in ``EQUAL``. The long licences' full texts, from their
titles (optional) to the end of their terms, are files of the same markup under ``licenses``.
"""

from __future__ import annotations

from pathlib import Path

FULL_TEXTS = Path(__file__).resolve().parent / "licenses"


def full_texts() -> dict[str, str]:
    """Apache-2.0, GPL-2.0, GPL-3.0, LGPL-2.1, LGPL-3.0 and MPL-2.0 by label; read on the driver."""
    return {p.stem: p.read_text(encoding="utf-8") for p in sorted(FULL_TEXTS.glob("*.txt"))}


# Published license wordings.
TEMPLATES: dict[str, str] = {
    "mit": """
<<beginOptional>>The MIT License <<beginOptional>>(MIT)<<endOptional>><<endOptional>> <<beginOptional>>Copyright <<var 20>><<endOptional>>
Permission is hereby granted, free of charge, to any person obtaining a copy of <<var 6>> software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
this permission notice <<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in all copies or
substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,
INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO
EVENT SHALL <<var 20>> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
""",
    "isc": """
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS"
AND <<var 10>> DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS. IN NO EVENT SHALL <<var 10>> BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS
ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.
""",
    "bsd-2-clause": """
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: <<beginOptional>>1.<<endOptional>> Redistributions of source code must retain the above copyright notice,
this list of conditions and the following disclaimer. <<beginOptional>>2.<<endOptional>> Redistributions in binary form must
reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY <<var 20>> "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED.
IN NO EVENT SHALL <<var 20>> BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING
NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
""",
    "bsd-3-clause": """
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: <<beginOptional>>1.<<endOptional>> Redistributions of source code must retain the above copyright notice,
this list of conditions and the following disclaimer. <<beginOptional>>2.<<endOptional>> Redistributions in binary form must
reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
materials provided with the distribution. <<beginOptional>>3.<<endOptional>> Neither the name of <<var 20>> nor the names of
<<var 4>> contributors may be used to endorse or promote products derived from this software without specific prior written
permission. THIS SOFTWARE IS PROVIDED BY <<var 20>> "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED
TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.
IN NO EVENT SHALL <<var 20>> BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING
NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
""",
    "apache-2.0-notice": """
Licensed under the Apache License, Version 2.0 <<beginOptional>>(the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at <<var 12>><<endOptional>>
""",
    "gpl-notice": """
free software <<var 2>> you can redistribute it and/or modify it under the terms of the GNU <<var 1>> General Public License
as published by the Free Software Foundation <<beginOptional>>either version <<var 2>> of the License
<<beginOptional>>or (at your option) any later version<<endOptional>><<endOptional>>
""",
    "gpl-reference": """
under <<beginOptional>>the terms of<<endOptional>> the GNU <<beginOptional>>Lesser<<endOptional>>
<<beginOptional>>Affero<<endOptional>> General Public License <<beginOptional>>version<<endOptional>>
<<beginOptional>>v<<endOptional>> <<var 2>>
""",
    "mit-notice": """
<<beginOptional>>This project is<<endOptional>> released under the MIT License
""",
    "mit-licensed": """
licensed under the MIT License
""",
    "cc-by": """
licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>the<<endOptional>> Creative Commons Attribution
<<beginOptional>>NonCommercial<<endOptional>> <<beginOptional>>ShareAlike<<endOptional>> <<var 3>> License
""",
    "cc-by-nc-4.0": """
licensed under CC BY-NC 4.0 <<beginOptional>>International<<endOptional>>
""",
    "cc-by-4.0": """
licensed under CC BY 4.0 <<beginOptional>>International<<endOptional>>
""",
    "all-rights-reserved": """
all rights reserved
""",
}

# Words that count as the same wording.
EQUAL: dict[str, str] = {
    "licence": "license",
    "licenced": "licensed",
    "sublicence": "sublicense",
    "organisation": "organization",
    "acknowledgement": "acknowledgment",
}
