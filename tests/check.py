"""Compare all registered queries with DuckDB: python tests/check.py FOLDER [query ...]"""

import sys

import conftest
from compare import check_all

if __name__ == "__main__":
    sys.exit(check_all(conftest.session(), sys.argv[1], sys.argv[2:]))
