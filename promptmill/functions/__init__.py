"""Column-to-column functions: text cleaning, JSON variants, chat prompts."""
