"""License wording as template markup, by label.

Fixed values: published license texts and notices. Markup: ``<<beginOptional>>`` ... ``<<endOptional>>`` may be left out;
``<<var;name="..";original="..";words="1-9">>`` stands for that many words of any kind; ``match=".."`` is a pattern each
of them must match.
"""

#: Phrases whose every place is counted.
PHRASES = {
    "mit": "under the MIT license",
    "apache-2": "Apache License version 2",
    "cc-by-nc": "CC BY NC",
}

_HOLDER = '<<var;name="holder";original="the copyright holders and contributors";words="1-20">>'
_NOTICE = '<<beginOptional>>this <<var;name="what";original="work";words="1-3">> is<<endOptional>> <<beginOptional>>free software<<endOptional>>'
_UNDER = f"{_NOTICE} <<beginOptional>>released<<endOptional>> <<beginOptional>>distributed<<endOptional>> <<beginOptional>>licensed<<endOptional>> under the <<beginOptional>>terms of the<<endOptional>>"
_CC = f'{_NOTICE} licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>the<<endOptional>>'
_VERSION = '<<beginOptional>>version<<endOptional>> <<beginOptional>>v<<endOptional>>'
_BSD_HEAD = """
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: <<beginOptional>>1<<endOptional>> Redistributions of source code must retain the
<<beginOptional>>above<<endOptional>> copyright notice, this list of conditions and the following disclaimer.
<<beginOptional>>2<<endOptional>> Redistributions in binary form must reproduce the above copyright notice, this list of
conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_TAIL = f"""
THIS SOFTWARE IS PROVIDED BY {_HOLDER} "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL {_HOLDER} BE
LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO,
PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND
ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN
ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""

TEMPLATES = {
    "mit": [
        """
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
this permission notice <<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in all copies or
substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,
INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN
NO EVENT SHALL <<var;name="holder";original="the authors or copyright holders";words="1-20">> BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION
WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
""",
        f"{_UNDER} MIT license",
    ],
    "isc": ["""
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS
IS" AND <<var;name="holder";original="the author";words="1-20">> DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL
<<var;name="holder";original="the author";words="1-20">> BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.
"""],
    "bsd-2": [_BSD_HEAD + _BSD_TAIL],
    "bsd-3": [_BSD_HEAD + f"""
<<beginOptional>>3<<endOptional>> Neither the name of {_HOLDER} nor the names of its contributors may be used to endorse
or promote products derived from this software without specific prior written permission.
""" + _BSD_TAIL],
    "apache-2": [
        """
Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at http <<beginOptional>>s<<endOptional>> www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License.
""",
        f"{_UNDER} Apache license {_VERSION} 2 <<beginOptional>>0<<endOptional>>",
    ],
    "gpl-2": [f'{_UNDER} GNU general public license <<beginOptional>>as published by the Free Software Foundation; either<<endOptional>> {_VERSION} <<var;name="version";original="2";match="2|v2";words="1-1">>'],
    "gpl-3": [f'{_UNDER} GNU general public license <<beginOptional>>as published by the Free Software Foundation, either<<endOptional>> {_VERSION} <<var;name="version";original="3";match="3|v3";words="1-1">>'],
    "lgpl": [f'{_UNDER} GNU <<var;name="kind";original="lesser";match="lesser|library";words="1-1">> general public license'],
    "agpl-3": [f'{_UNDER} GNU affero general public license'],
    "mpl-2": [f"""
This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at http <<beginOptional>>s<<endOptional>> mozilla.org/MPL/2.0
""", f"{_UNDER} Mozilla public license {_VERSION} 2 <<beginOptional>>0<<endOptional>>"],
    "unlicense": ["""
This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,
compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,
commercial or non-commercial, and by any means.
"""],
    "cc-by": [f'{_CC} creative commons attribution <<var;name="version";original="4";match="[0-9]";words="1-1">>', f'{_CC} CC BY <<var;name="version";original="4";match="[0-9]";words="1-1">>'],
    "cc-by-sa": [f"{_CC} creative commons attribution share <<beginOptional>>alike<<endOptional>>", f"{_CC} creative commons attribution sharealike", f"{_CC} CC BY SA"],
    "cc-by-nc": [f"{_CC} creative commons attribution <<var;name=\"kind\";original=\"noncommercial\";match=\"noncommercial|non\";words=\"1-1\">> <<beginOptional>>commercial<<endOptional>>", f"{_CC} CC BY NC"],
}
