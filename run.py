"""File to hand to ``spark-submit``; see ``tierline/__main__.py``."""

from tierline.__main__ import main

if __name__ == "__main__":
    main()
