"""Operators a training-data pipeline needs beside the register jobs; nothing outside imports this."""
