"""Training-data operators for language models. Nothing outside imports this."""
