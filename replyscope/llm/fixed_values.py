"""Fixed values of the operators: patterns, phrases and texts that results depend on."""

# Words of ASCII-lower-cased UTF-8 bytes: digits, a-z and everything outside ASCII
WORD_BYTES = rb"[0-9a-z\x80-\xff]+"
# The same words for Java and RE2, on lower-cased text
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The same words on text whose case was kept
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

# Phrases that must stand whole: (label, words)
BASE_PHRASES = [
    ("cc-by", "cc by"),
    ("gpl", "general public license"),
    ("reserved", "all rights reserved"),
]

# Licence notices that may be found in part: (label, text)
LICENCE_TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    (
        "apache-2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software "
        'distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
        "either express or implied. See the License for the specific language governing permissions and limitations "
        "under the License.",
    ),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    (
        "bsd",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
        "the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc0", "The person who associated a work with this deed has dedicated the work to the public domain"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("mit", "Released under the MIT License"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    (
        "mpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
]

# Secrets: (kind, pattern, group whose length counts, least length)
SECRET_PATTERNS = [
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]+", 0, 16),
]

# Characters that a chat template needs, and what stands for them inside a text
CHAT_ESCAPES = [("\\", "\\\\"), ("<", "\\l"), ("[", "\\o")]
