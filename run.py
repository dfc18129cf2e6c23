"""Entry file for spark-submit."""

from saleswright.__main__ import main

main()
