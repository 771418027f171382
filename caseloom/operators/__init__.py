"""Analytical operators. Every public function takes DataFrames and returns a lazy DataFrame."""
