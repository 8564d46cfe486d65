"""Licence notices to look for: label, text, mandatory phrases.

Fixed values: public notices, short ones and whole permission texts, as their publishers word them.
"""

TEMPLATES: list[tuple[str, str, list[str]]] = [
    ("mit", "Released under the MIT License.", ["mit license"]),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files", ["permission is hereby granted free of charge"]),
    ("apache", "Licensed under the Apache License, Version 2.0.", ["apache license"]),
    ("gpl", "This work is licensed under the GNU General Public License, version 3.",
     ["general public license"]),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of "
            "the GNU General Public License as published by the Free Software Foundation",
     ["gnu general public license"]),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software "
             "Foundation", ["lesser general public license"]),
    ("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software "
             "Foundation", ["affero general public license"]),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0.", ["cc by nc"]),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0.", ["cc by sa"]),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License.",
     ["creative commons attribution", "international license"]),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met", ["redistribution and use in source and binary forms"]),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
     ["mozilla public license"]),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
            "fee is hereby granted", ["permission to use copy modify"]),
    ("unlicense", "This is free and unencumbered software released into the public domain.",
     ["unencumbered software released into the public domain"]),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
            "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
            "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
            "subject to the following conditions: The above copyright notice and this permission notice shall be "
            "included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", "
            "WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
            "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS "
            "OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
            "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR "
            "OTHER DEALINGS IN THE SOFTWARE.",
     ["permission is hereby granted free of charge", "the software is provided as is"]),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
               "in compliance with the License. You may obtain a copy of the License at "
               "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
               "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
               "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
               "language governing permissions and limitations under the License.",
     ["in compliance with the license", "governing permissions and limitations under the license"]),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
            "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
            "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
            "documentation and/or other materials provided with the distribution.",
     ["redistributions of source code must retain the above copyright notice"]),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all "
            "copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS "
            "SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
     ["the author disclaims all warranties"]),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the "
             "authors be held liable for any damages arising from the use of this software. Permission is granted to "
             "anyone to use this software for any purpose, including commercial applications, and to alter it and "
             "redistribute it freely, subject to the following restrictions",
     ["to alter it and redistribute it freely"]),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation, either version 3 of the License, "
            "or (at your option) any later version. This program is distributed in the hope that it will be useful, "
            "but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
            "PARTICULAR PURPOSE. See the GNU General Public License for more details.",
     ["gnu general public license", "distributed in the hope that it will be useful"]),
]

# Phrases whose bare presence names a licence.
BASE_PHRASES: list[tuple[str, str]] = [
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
]
