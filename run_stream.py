"""Entry point for spark-submit; see tallymonth.streaming.__main__."""

from tallymonth.streaming.__main__ import main

if __name__ == "__main__":
    main()
