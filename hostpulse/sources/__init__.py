"""Where lines and tables come from and go to."""
