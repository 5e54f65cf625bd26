"""The five stages and table administration as one plan each."""
