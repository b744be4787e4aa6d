"""Entry script for ``spark-submit``; see ``python run.py --help``."""

from cellweave.cli import main

if __name__ == "__main__":
    main()
