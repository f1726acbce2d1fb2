"""Part of the cantor pronunciation and speech-corpus engine."""
