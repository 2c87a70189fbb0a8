"""``python -m crease INPUT OUTPUT``: run the batch job (see plans/pipeline.main)."""

from crease.plans.pipeline import main

if __name__ == "__main__":
    main()
