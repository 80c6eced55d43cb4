"""Where the tests find their tables. A module of its own: the name `conftest` belongs to more than one folder."""

FOLDER = "/root/testdata/sf0.001"
