"""Entry script for spark-submit; see `python -m tallymonth --help`."""

from tallymonth.__main__ import main

if __name__ == "__main__":
    main()
