"""DataFrame to DataFrame operators; none of them runs a Spark action unless it says so."""
