"""Whole licence wordings against altered ones, written out independently of the templates."""

from __future__ import annotations

from parcelforge.llm import licences

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the
Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to
permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,
WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
BSD_3 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials
provided with the distribution.
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written
permission.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,
EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF
ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
BSD_2 = BSD_3[: BSD_3.index("3. Neither")] + BSD_3[BSD_3.index("THIS SOFTWARE") :]
BSD_4 = BSD_3.replace("3. Neither", "3. All advertising materials mentioning features or use of this software must display the following acknowledgement:\nThis product includes software developed by the Example Group.\n4. Neither")
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this
permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE,
DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation,
either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General
Public License along with this program. If not, see <https://www.gnu.org/licenses/>."""
LGPL = GPL.replace("This program", "This library").replace("this program", "this library").replace("GNU General", "GNU Lesser General").replace("version 3", "version 2.1")
APACHE = """Licensed under the Apache License, 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
WHOLE = {"mit": [MIT], "bsd": [BSD_2, BSD_3, BSD_4], "isc": [ISC], "gpl": [GPL, LGPL], "apache": [APACHE]}
ALTERED = [
    MIT.replace("subject to the following", "for non-commercial use only, subject to the following"), MIT[: MIT.index("(the")] + "for non-commercial use only.", MIT.replace("sell", "rent"),
    BSD_3.replace("2. Redistributions", "2. Commercial redistributions"), ISC[: ISC.index("provided")], ISC.replace("FITNESS", "TITLE"),
    # the Apache-1.1, OpenSSL and PHP licences open as BSD does
    BSD_3[: BSD_3.index("3. Neither")] + "3. The end-user documentation included with the redistribution, if any, must include the following acknowledgment",
    GPL[: GPL.index("as published")], GPL.replace("useful", "harmless"), APACHE[: APACHE.index("You may")], APACHE.replace("OR CONDITIONS", ""),
]


def test_whole_and_altered_wordings(spark):
    whole = [(label, text) for label, texts in WHOLE.items() for text in texts]
    rows = [(i, f"Copyright 2020 Someone.\n{text}\nMore.") for i, (_, text) in enumerate(whole)] + [(100 + i, text) for i, text in enumerate(ALTERED)]
    got = {r["doc_id"]: r for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, (label, _) in enumerate(whole):
        assert (got[i]["labels"].split(","), got[i]["score"]) in (([label], 1.0), (sorted({label, *got[i]["base_labels"].split(",")}), 1.0)), i
    for i in range(len(ALTERED)):
        assert got[100 + i]["score"] < 1.0 and got[100 + i]["labels"] == got[100 + i]["base_labels"], i
