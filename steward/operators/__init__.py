"""DataFrame-to-DataFrame operators. None of them triggers an action unless its docstring says so."""
