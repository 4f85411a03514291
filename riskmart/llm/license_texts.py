"""What the license scan looks for: base phrases, names with a version, and notices as they stand in files."""

from __future__ import annotations

from typing import NamedTuple


class Template(NamedTuple):
    label: str
    text: str
    #: Words of a rolling gram.
    gram: int
    #: Found only where all its words stand consecutively; else by a share of its words.
    exact: bool = False
    #: Counts as a place of the base scan.
    base: bool = False


# The phrases and labels of the base scan.
PHRASES = [
    Template("gpl", "gnu general public license", 2, exact=True, base=True),
    Template("apache", "apache license", 2, exact=True, base=True),
    Template("cc-by", "cc by", 2, exact=True, base=True),
    Template("mit", "mit license", 2, exact=True, base=True),
]

# Names that tell a version or variant.
NAMES = [
    Template("agpl", "gnu affero general public license", 3, exact=True),
    Template("apache-2.0", "apache license version 2 0", 3, exact=True),
    Template("cc-by-nc", "cc by nc", 3, exact=True),
    Template("cc-by-nd", "cc by nd", 3, exact=True),
    Template("cc-by-sa", "cc by sa", 3, exact=True),
    Template("gpl-2", "gnu general public license version 2", 3, exact=True),
    Template("gpl-3", "gnu general public license version 3", 3, exact=True),
    Template("lgpl", "gnu lesser general public license", 3, exact=True),
    Template("mpl-2.0", "mozilla public license version 2 0", 3, exact=True),
    Template("cc-by", "creative commons attribution 4 0 international license", 3, exact=True),
    Template("cc-by-sa", "creative commons attribution sharealike 4 0 international license", 3, exact=True),
    Template("cc-by-nc", "creative commons attribution noncommercial 4 0 international license", 3, exact=True),
]

# Notices: the usual wording of license headers and short license texts.
NOTICES = [
    Template(
        "mit",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including
        without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
        copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
        following conditions""",
        5,
    ),
    Template(
        "bsd",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided
        that the following conditions are met""",
        5,
    ),
    Template(
        "isc",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies""",
        5,
    ),
    Template(
        "zlib",
        """Permission is granted to anyone to use this software for any purpose, including commercial applications,
        and to alter it and redistribute it freely, subject to the following restrictions""",
        5,
    ),
    Template(
        "bsl-1.0",
        """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the
        software and accompanying documentation covered by this license (the "Software") to use, reproduce, display,
        distribute, execute, and transmit the Software""",
        5,
    ),
    Template(
        "unlicense",
        """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
        publish, use, compile, sell, or distribute this software""",
        5,
    ),
    Template(
        "apache-2.0",
        """you may not use this file except in compliance with the License. You may obtain a copy of the License
        at""",
        5,
    ),
    Template(
        "gpl",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation""",
        5,
    ),
    Template(
        "lgpl",
        """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser
        General Public License as published by the Free Software Foundation""",
        5,
    ),
    Template(
        "agpl",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero
        General Public License as published by the Free Software Foundation""",
        5,
    ),
    Template("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License", 5),
    Template(
        "cc0",
        """To the extent possible under law, the author has waived all copyright and related or neighboring rights
        to this work""",
        5,
    ),
]

TEMPLATES = [*PHRASES, *NAMES, *NOTICES]
