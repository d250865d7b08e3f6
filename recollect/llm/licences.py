"""Licence notices to look for: label, text, and the phrases that must be in it.

The texts are those of the public licences and of the usual lines that refer to them.
"""

# Licence notices
NOTICES = [
    ("mit",
     "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
     "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
     "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
     "subject to the following conditions",
     ["permission is hereby granted free of charge", "without restriction"]),
    ("isc",
     "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
     "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
     ["with or without fee is hereby granted"]),
    ("bsd",
     "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
     "that the following conditions are met: Redistributions of source code must retain the above copyright "
     "notice, this list of conditions and the following disclaimer.",
     ["redistribution and use in source and binary forms"]),
    ("bsd-3-clause",
     "may be used to endorse or promote products derived from this software without specific prior written permission",
     ["endorse or promote products"]),
    ("zlib",
     "This software is provided 'as-is', without any express or implied warranty. In no event will the authors "
     "be held liable for any damages arising from the use of this software.",
     ["held liable for any damages arising from the use"]),
    ("apache-2.0",
     "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
     "compliance with the License. You may obtain a copy of the License at",
     ["apache license version 2 0", "except in compliance with the license"]),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0", ["apache license version 2 0"]),
    ("mpl-2.0",
     "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
     ["mozilla public license v 2 0"]),
    ("gpl",
     "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
     "Public License as published by the Free Software Foundation",
     ["gnu general public license as published by the free software foundation"]),
    ("gpl-3.0", "licensed under the GNU General Public License, version 3", ["general public license version 3"]),
    ("gpl-2.0", "licensed under the GNU General Public License, version 2", ["general public license version 2"]),
    ("lgpl", "under the terms of the GNU Lesser General Public License", ["gnu lesser general public license"]),
    ("agpl", "under the terms of the GNU Affero General Public License", ["gnu affero general public license"]),
    ("unlicense",
     "This is free and unencumbered software released into the public domain.",
     ["unencumbered software released into the public domain"]),
    ("cc-by-4.0",
     "licensed under a Creative Commons Attribution 4.0 International License",
     ["creative commons attribution 4 0"]),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0", ["cc by nc 4 0"]),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0", ["cc by sa 4 0"]),
    ("mit", "Released under the MIT License", ["mit license"]),
]

# Phrases whose places are counted, with their labels
PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]
