from llm.helpers import make, prose  # noqa: F401
